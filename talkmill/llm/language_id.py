"""Language identification with segmentation-marginalised unigrams.

A language is a distribution over the pieces of a fixed public vocabulary. The probability of a word is the sum over all
its segmentations into pieces, found by a forward pass; that of a text is the product over its words, as no piece
reaches over a space. The piece probabilities are learned by expectation maximisation: forward and backward passes over
the words of each language, weighted by their counts, give expected piece counts.

Both passes run over all words of one length at once: pieces are found by a rolling hash in an open table of all pieces
and their prefixes, and a word is only followed from a place as long as some piece begins so.

Training reads every labelled text: counts of (language, word) are added up in the map tasks before they are shuffled;
each round of the maximisation adds up at most pieces x languages numbers, which is all that the driver ever gets.
Words of any length are summed whole, with sums scaled every STRIDE characters so that none vanishes; a word takes time in
proportion to its length. A character that is no piece is its UTF-8 bytes, which the vocabulary has as pieces. A text's score is the posterior of its best language under equal priors, with the log-likelihoods divided by
the square root of the number of words, since words are not independent.

Cases: null text, or one without a letter: und, score 0. A training table without a single labelled word: all und.
Letters are those of str.isalpha (so number signs are none). A null language labels nothing. Ties go to the language that is first by code point. Rows that repeat count each time.
Other columns stay unless an output column has their name.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, documents, held_out, mix64, partitions, small, words_of
from .sentencepiece_codec import META, NORMAL, model, public_model

ROUNDS = 2
#: Characters after which the sums over a word's segmentations are scaled anew.
STRIDE = 32
#: Added to the expected count of each piece of a language.
FLOOR = 0.01
#: Distinct words that a worker remembers the scores of, and that a map task counts before it hands them on.
REMEMBER, COUNTED = 400_000, 200_000
#: Rows and bytes of texts whose new words are looked up together.
TOGETHER = (5000, 16 << 20)
LETTER = re.compile(r"[^\W\d_]")
#: Stand for the 256 bytes: lone surrogates, which no text has.
BYTES = [chr(0xDC00 + b) for b in range(256)]
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: What a table lookup gives besides pieces.
NONE, PREFIX = -1, -2


class Spelling(dict):
    """For str.translate: characters that are pieces stay, all others become their bytes."""

    def __init__(self, chars):
        super().__init__((ord(c), c) for c in chars)

    def __missing__(self, point: int) -> str:
        return "".join(BYTES[b] for b in chr(point).encode("utf-8", "surrogatepass"))


class Vocabulary:
    """Pieces and their prefixes as hashes of their code points, in an open-addressing table."""

    def __init__(self, pieces: list[str]):
        self.n = len(pieces)
        ids = {p: i for i, p in reversed(list(enumerate(pieces)))}
        every = sorted({p[:k] for p in pieces for k in range(1, len(p) + 1)})
        bits = max(4, (4 * len(every)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.keys, self.ids = np.zeros(1 << bits, np.uint64), np.full(1 << bits, NONE, np.int32)
        self.probes = 0
        for p in every:
            h = self.hash(p)
            at, step = int(h & self.mask), 0
            while self.keys[at]:
                at, step = (at + 1) & int(self.mask), step + 1
            self.keys[at], self.ids[at] = h, ids.get(p, PREFIX)
            self.probes = max(self.probes, step)
        self.longest = max(map(len, pieces), default=1)
        self.spelled = Spelling(p for p in pieces if len(p) == 1)

    @staticmethod
    def hash(piece: str) -> np.uint64:
        h = np.zeros(1, np.uint64)
        with np.errstate(over="ignore"):
            for c in piece:
                h = (h + np.uint64(ord(c) + 1)) * _BASE
        return mix64(h)[0]

    def find(self, h: np.ndarray) -> np.ndarray:
        """The piece of each hash; PREFIX for what only begins a piece, NONE for all else."""
        at = h & self.mask
        key = self.keys[at]
        out = np.where(key == h, self.ids[at], NONE)
        miss = np.flatnonzero((key != h) & (key != 0))
        for _ in range(self.probes):
            if not len(miss):
                break
            at[miss] = (at[miss] + np.uint64(1)) & self.mask
            key = self.keys[at[miss]]
            hit = key == h[miss]
            out[miss[hit]] = self.ids[at[miss[hit]]]
            miss = miss[~hit & (key != 0)]
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The pieces of a model's file, and the 256 bytes."""
    return Vocabulary([p for p, kind in model(path).pieces if kind == NORMAL] + BYTES)


class Lattice:
    """Spelled words of one length (with the meta symbol in front) and the pieces at each pair of places."""

    def __init__(self, vocab: Vocabulary, words: list[str]):
        self.length, self.n, self.reach = len(words[0]), len(words), vocab.longest
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(self.n, self.length).T.copy()
        #: (from, to, words, pieces): which words have which piece there
        self.pieces: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        with np.errstate(over="ignore"):
            for i in range(self.length):
                on, h = np.arange(self.n), np.zeros(self.n, np.uint64)
                for j in range(i + 1, min(i + self.reach, self.length) + 1):
                    h = (h + points[j - 1][on].astype(np.uint64) + np.uint64(1)) * _BASE
                    found = vocab.find(mix64(h))
                    some = np.flatnonzero(found != NONE)  # the others begin no piece
                    if not len(some):
                        break
                    if len(some) < len(on):
                        on, h, found = on[some], h[some], found[some]
                    hit = np.flatnonzero(found >= 0)
                    if len(hit):
                        self.pieces.append((i, j, on[hit], found[hit].astype(np.int64)))

    def sums(self, steps: list[tuple[int, int, np.ndarray, np.ndarray]], width: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """(sums, logs of their scales) at each place over all ways there by steps (from, to, words, probabilities), sorted by
        where they begin. What is scaled at a place is all that steps before it have reached."""
        sums, scale = np.zeros((self.length + 1, self.n, *width)), np.zeros((self.length // STRIDE + 1, self.n, *width))
        sums[0] = 1.0
        done = 0
        for i, j, on, q in steps:
            while done < i // STRIDE:
                done += 1
                self._scale(sums, scale, done)
            sums[j][on] += sums[i][on] * q
        while done < self.length // STRIDE:
            done += 1
            self._scale(sums, scale, done)
        return sums, scale

    def _scale(self, sums: np.ndarray, scale: np.ndarray, k: int) -> None:
        part = sums[k * STRIDE : k * STRIDE + self.reach]
        most = part.max(axis=0)
        most[most == 0] = 1.0
        part /= most
        scale[k] = scale[k - 1] + np.log(most)

    def forward(self, p: np.ndarray) -> np.ndarray:
        """p: pieces x languages. The logs of the words' probabilities: words x languages."""
        sums, scale = self.sums([(i, j, on, p[found]) for i, j, on, found in self.pieces], (p.shape[1],))
        return np.log(np.maximum(sums[-1], 1e-300)) + scale[-1]

    def expected(self, p: np.ndarray, lang: np.ndarray, n: np.ndarray, out: np.ndarray) -> None:
        """Adds to out (pieces x languages) how often each piece is expected in words of the given languages and counts."""
        steps = [(i, j, on, p[found, lang[on]]) for i, j, on, found in self.pieces]
        alpha, a_log = self.sums(steps, ())
        beta, b_log = self.sums([(self.length - j, self.length - i, on, q) for i, j, on, q in sorted(steps, key=lambda x: -x[1])], ())
        whole = np.log(np.maximum(alpha[-1], 1e-300)) + a_log[-1]
        for (i, j, on, q), (_, _, _, found) in zip(steps, self.pieces):
            k = self.length - j
            share = alpha[i][on] * q * beta[k][on] * np.exp(a_log[i // STRIDE][on] + b_log[k // STRIDE][on] - whole[on])
            np.add.at(out, (found, lang[on]), share * n[on])


def by_length(words: list[str], most: int = 20_000) -> list[list[int]]:
    """Places of words of one length; groups of long words are smaller, to bound their tables."""
    groups: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        groups.setdefault(len(w), []).append(k)
    return [g[i : i + step] for x, g in groups.items() for step in [max(1, min(most, 500_000 // (x + 1)))] for i in range(0, len(g), step)]


def log_probabilities(vocab: Vocabulary, p: np.ndarray, words: list[str]) -> np.ndarray:
    """The log of each word's probability, all segmentations summed: words x languages."""
    out = np.zeros((len(words), p.shape[1]))
    spelled = [META + w.translate(vocab.spelled) for w in words]
    for group in by_length(spelled):
        out[group] = Lattice(vocab, [spelled[k] for k in group]).forward(p)
    return out


def expected(vocab: Vocabulary, p: np.ndarray, words: list[str], langs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Expected counts of the pieces by language (pieces x languages) for words of the given languages and counts."""
    out = np.zeros(p.shape)
    spelled = [META + w.translate(vocab.spelled) for w in words]
    for group in by_length(spelled):
        Lattice(vocab, [spelled[k] for k in group]).expected(p, langs[group], counts[group], out)
    return out


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in LETTER.finditer(text))


def word_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, word, n) over all rows with a language, added up before and after the shuffle."""

    def run(batches):
        counts: dict[str, Counter] = {}

        def flush():
            keys = [(lang, w, n) for lang, words in counts.items() for w, n in words.items()]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*keys) if keys else [[]] * 3, (pa.string(), pa.string(), pa.int64()))], names=["lang", "word", "n"])

        for batch in small(batches):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, counts.values())) > COUNTED:
                yield flush()
        yield flush()

    rows = docs.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    return rows.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class LanguageModel:
    def __init__(self, path: str, langs: list[str], p: np.ndarray):
        self.path, self.langs, self.p = path, langs, p


def fit(docs: DataFrame, path: str, text: str = "text", lang: str = "lang", rounds: int = ROUNDS) -> LanguageModel:
    """Learns from all rows with a language. On the driver: the languages and, each round, the pieces' expected counts."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    counts = scratch.keep(word_counts(docs, text, lang))
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())
    vocab = vocabulary(path)
    p = np.full((vocab.n, len(langs)), 1.0 / max(1, vocab.n))
    if not langs:
        return LanguageModel(path, langs, p)
    rows = counts.repartition(max(partitions(spark), 8))
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(p.astype(np.float32))  # pieces x languages

        def run(batches, now=now):
            vocab, q, where = vocabulary(path), now.value.astype(np.float64), {x: i for i, x in enumerate(langs)}
            total = np.zeros(q.shape)
            for batch in small(batches, 50_000):
                lang = np.array([where[x] for x in batch.column(0).to_pylist()], np.int64)
                total += expected(vocab, q, batch.column(1).to_pylist(), lang, batch.column(2).to_numpy().astype(float))
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(total[piece, lang])], names=["piece", "lang", "n"])

        found = rows.mapInArrow(run, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toArrow().to_pandas()
        p = np.full((vocab.n, len(langs)), FLOOR)
        np.add.at(p, (found["piece"].to_numpy(), found["lang"].to_numpy()), found["n"].to_numpy())
        p /= p.sum(axis=0)
        now.unpersist()
    scratch.drop(counts)
    return LanguageModel(path, langs, p)


class Numbers(dict):
    """Numbers words as they come; `new` lists those whose scores are not known yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        k = self[word] = len(self)
        self.new.append(word)
        return k


def predict(docs: DataFrame, learned: LanguageModel, text: str = "text") -> DataFrame:
    """Adds lang_pred and score."""
    spark = docs.sparkSession
    kept = docs.select(F.col(text).alias("_text"), *[F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score", "_text")])
    schema = T.StructType([*kept.schema.fields[1:], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    path, langs = learned.path, learned.langs
    table = spark.sparkContext.broadcast(learned.p.astype(np.float32))  # pieces x languages

    def run(batches):
        vocab, p = vocabulary(path), table.value.astype(np.float64)
        known, scores = Numbers(), np.zeros((0, len(langs)))
        for batch in small(batches, *TOGETHER):
            if len(known) > REMEMBER:
                known, scores = Numbers(), scores[:0]
            words = [np.fromiter(map(known.__getitem__, words_of(t)) if langs and t and has_letter(t) else (), np.int64) for t in batch.column(0).to_pylist()]
            if known.new:
                scores = np.concatenate([scores, log_probabilities(vocab, p, known.new)])
                known.new = []
            pred, score = [], []
            for x in words:
                if not len(x):
                    pred.append("und")
                    score.append(0.0)
                    continue
                total = scores[x].sum(axis=0) / np.sqrt(len(x))
                best = int(total.argmax())
                pred.append(langs[best])
                score.append(float(1.0 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=schema.names)

    return kept.mapInArrow(run, schema)


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = held_out(F.col("doc_id"), 4, 2)
    learned = fit(docs.where(~out).select("text", "lang"), public_model())
    return predict(docs.select("doc_id", "text", out.alias("held_out")), learned)
