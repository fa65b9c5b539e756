"""LM scoring: a Katz back-off model with Good-Turing discounts and exactly normalised back-off weights.

For a word w after a history h of up to order - 1 words (less at the start of a text, which counts as one of them):

    p(w | h) = d(c(h w)) c(h w) / c(h)     if h w was seen        p(w) = d(c(w)) c(w) / N    if w was seen
             = a(h) p(w | h')               if h was seen               = what the discounts leave, for all others as one
             = p(w | h')                    else                  h': h without its first word
    a(h)     = (1 - sum of p(w | h) over w seen after h) / (1 - sum of p(w | h') over the same w)

Discounts are Katz's, for each order: counts up to TOP get Good-Turing's, less what leaves higher counts alone; where counts
of counts don't allow that, absolute discounting. A history all of whose followers were seen more than TOP times leaves
nothing; its denominator is then one larger, so that something is left. Words seen after h were seen after h', so the sums in
a(h) are over discounted counts, which are kept as integers (how often followers have which count): the weights are exact
however the work is split.

The work goes by chunks of documents and buckets of n-grams, in rounds of requests and answers, each a shuffle of packed
arrays rather than of a row for each token:

1. Chunks (tokens as numbers of the chunk's own words) are written to the shared folder, as a table bucketed by chunk, so that later
   only answers are shuffled to them.
2. For each order, each chunk sends its n-grams and their training counts to buckets of the n-gram's hash; each bucket adds up,
   stores its n-grams and counts, and answers each chunk with the global counts, in the order asked. The first chunk that
   has an n-gram is told to be its owner.
3. With counts and owners a chunk finds, for its histories, what its own n-grams add to the sums in a(h), and scores all but what
   depends on other chunks' n-grams; the sums go to buckets of the history, which store the weights; those a chunk needs come
   back, and each token's back-off is evaluated from its longest history down. Only held-out texts and frequent n-grams need
   weights, so buckets mark in step 2 the n-grams that occur there, and sums of others are only sent for a store that is kept.

The store holds, partitioned by order and bucket, the tables of n-gram counts and of histories' weights; score_stored()
evaluates other documents from one that is kept. Corpus statistics grow with the corpus but are spread over buckets; a worker holds one chunk
or one bucket. Hot words, histories and n-grams are one entry a chunk.

Words are told apart by hashes of 64 bits, longer n-grams by hashes so wide that one in 2 ** SPARE is taken for another at
most, 64 bits at most.

Cases: null and empty texts are one end token; very long texts count whole; a chunk closes after the document that
reaches CHUNK tokens; with no training documents every count is 0 and all tokens are the one unknown class, of probability
1; rows that repeat count each time; a null id goes by the crc32 of the empty text; other columns are not read.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, bucket_bits, crc_mod, documents, lean, lower_ascii, mix64, partitions, shared_dir, small, words_of

ORDER = 3
TOP = 5
CHUNK = 600_000
SPARE = 20
REMEMBER = 200_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: The start and the end of a text; no word has white space.
START, END = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b"\t", b"\n"))


def pack(a: np.ndarray) -> bytes:
    """64-bit numbers, compressed by their bytes' places."""
    a = np.ascontiguousarray(a)
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(-1, 8).T.tobytes()) if len(a) else b""


def unpack(x: bytes, kind: type = np.int64) -> np.ndarray:
    if not x:
        return np.zeros(0, kind)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view(kind).ravel()


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=np.uint64(0)))


def unpack_sorted(x: bytes) -> np.ndarray:
    return np.cumsum(unpack(x, np.uint64), dtype=np.uint64)


def parts(keys: np.ndarray, bits: int, width: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the buckets, by leading bits, of sorted keys of `width` bits; without empty ones."""
    b = (keys >> np.uint64(width - bits)).astype(np.int64)
    at = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])) if len(b) else np.zeros(0, np.int64)
    return [(int(b[i]), int(i), int(j)) for i, j in zip(at, np.append(at[1:], len(b)))]


def discounts(counts_of_counts: np.ndarray) -> np.ndarray:
    """d[1 ... TOP] (d[0] is unused), each in (0, 1); counts_of_counts[r] is the number of n-grams seen r times, r <= TOP + 1."""
    n = counts_of_counts.astype(float)
    d = np.ones(TOP + 1)
    if n[1] > 0 and n[2] > 0:
        high = (TOP + 1) * n[TOP + 1] / n[1]
        good = True
        for r in range(1, TOP + 1):
            if not n[r] or high >= 1:
                good = False
                break
            d[r] = ((r + 1) * n[r + 1] / (r * n[r]) - high) / (1 - high)
            good = good and 0 < d[r] < 1
        if good:
            return d
    absolute = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    return np.array([1.0, *((r - absolute) / r for r in range(1, TOP + 1))])


def count_counts(c: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(c[(c > 0) & (c <= TOP + 1)], TOP + 1), minlength=TOP + 2)


class Words(dict):
    """Hashes of words."""

    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def chunk_table(rows: DataFrame, modulus: int, remainder: int, chunk_tokens: int) -> DataFrame:
    """(chunk, n, docs, held, lens, vocab, tokens): the number of tokens, documents' ids, whether held out, numbers of tokens, the
    sorted hashes of the chunk's words, and each token's place among them."""

    def run(batches):
        task, made = TaskContext.get().partitionId() << 24, 0
        known = Words()
        docs: list = []
        hashes: list = []
        size = 0

        def close():
            nonlocal docs, hashes, size, made
            flat = np.concatenate(hashes)
            vocab, tokens = np.unique(flat, return_inverse=True)
            lens = np.array([len(x) for x in hashes], np.int64)
            held = np.array([crc_mod(i, modulus) == remainder for i in docs], np.int64)
            out = pa.RecordBatch.from_arrays([pa.array([task | made], pa.int64()), pa.array([len(flat)], pa.int64()), pa.array([docs], pa.list_(pa.int64())), *(pa.array([x], pa.binary()) for x in (pack(held), pack(lens), pack_sorted(vocab), pack(tokens.astype(np.int64))))], names=["chunk", "n", "docs", "held", "lens", "vocab", "tokens"])
            docs, hashes, size, made = [], [], 0, made + 1
            return out

        for batch in small(batches):
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(lower_ascii(text)) if text else []
                if len(known) > REMEMBER:
                    known.clear()
                hashes.append(np.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)), END))
                docs.append(i)
                size += len(words) + 1
                if size >= chunk_tokens:
                    yield close()
        if docs:
            yield close()

    return rows.mapInArrow(run, "chunk long, n long, docs array<long>, held binary, lens binary, vocab binary, tokens binary")


class Level:
    """A chunk's n-grams of one order: their sorted keys, each token's place among them (-1: none), training counts, whether a
    held-out text has them, each token's history's place among the n-grams of the order below (order 1: none), and a token of
    each n-gram."""

    def __init__(self, keys: np.ndarray, at: np.ndarray, train: np.ndarray, history: np.ndarray | None, width: int):
        self.keys, self.at, self.history, self.width = keys, at, history, width
        there = at >= 0
        self.counts = np.bincount(at[there & train], minlength=len(keys)).astype(np.int64)
        self.held = np.bincount(at[there & ~train], minlength=len(keys)) > 0
        self.some = np.zeros(len(keys), np.int64)
        self.some[at[there]] = np.flatnonzero(there)


class Chunk:
    """levels[k]: order k + 1. The words' level also has the start of a text. With `last`, longer orders have only the last."""

    def __init__(self, held: bytes, lens: bytes, vocab: bytes, tokens: bytes, orders: int, width: int, last: bool = False):
        self.held, self.lens = unpack(held).astype(bool), unpack(lens)
        vocab, tokens = unpack_sorted(vocab), unpack(tokens)
        self.doc = np.repeat(np.arange(len(self.lens)), self.lens)
        first = np.cumsum(self.lens) - self.lens
        place = np.arange(len(tokens)) - first[self.doc]
        train = ~self.held[self.doc]
        start = int(np.searchsorted(vocab, START))
        names, own = np.insert(vocab, start, START), tokens + (tokens >= start)
        self.levels = [Level(names, own, train, None, 64)]
        self.levels[0].counts[start], self.levels[0].held[start] = (~self.held).sum(), self.held.any()
        raw = word = vocab[tokens]
        before = np.concatenate([[start], own[:-1]])
        before[first] = start
        hashes = names[before]
        for k in range(2, orders + 1):
            if k > 2:
                before = np.concatenate([[-1], self.levels[-1].at[:-1]])
                hashes = np.concatenate([[START], raw[:-1]])
            there = place >= k - 2
            with np.errstate(over="ignore"):
                raw = mix64(hashes * _BASE + word)
            if last and k < orders:
                continue
            keys, inverse = np.unique(raw[there] >> np.uint64(64 - width), return_inverse=True)
            at = np.full(len(tokens), -1)
            at[there] = inverse
            self.levels.append(Level(keys, at, train, np.where(there, before, -1), width))


_CHUNK = ("held", "lens", "vocab", "tokens")


def ask(chunks: DataFrame, order: int, bits: int, width: int, every: bool = False) -> DataFrame:
    """(bucket, chunk, keys, counts, held): each chunk's n-grams of one order; held: whether their weights may be needed."""

    def run(batches):
        for batch in small(batches, 1):  # a chunk is a row of megabytes
            for chunk, *rest in zip(*(batch.column(i).to_pylist() for i in range(5))):
                level = Chunk(*rest, order, width, True).levels[-1]
                cut = parts(level.keys, bits, level.width)
                held = level.held | every
                cols = [[b for b, _, _ in cut], [chunk] * len(cut), *([f(x[i:j]) for _, i, j in cut] for f, x in ((pack_sorted, level.keys), (pack, level.counts), (_bits, held)))]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=["bucket", "chunk", "keys", "counts", "held"])

    return chunks.select("chunk", *_CHUNK).mapInArrow(run, "bucket int, chunk long, keys binary, counts binary, held binary")


def _bits(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.packbits(x).tobytes())


def _unbits(x: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8), count=n).astype(bool)


ANSWER = "kind string, chunk long, counts binary, owned binary, needed binary, keys binary, bucket int"


def _answers(rows: list[tuple]) -> pa.Table:
    kinds = (pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int32())
    return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 7, kinds)], names=["kind", "chunk", "counts", "owned", "needed", "keys", "bucket"])


def answer(asked: DataFrame, words: bool) -> DataFrame:
    """For each bucket an answer to each chunk (the global counts of its keys; which it owns; which may need weights), its totals
    (tokens, types, counts of counts), and its keys and counts."""

    def add(key, table):
        table = table.sort_by("chunk")
        keys = [unpack_sorted(x) for x in table.column("keys").to_pylist()]
        own = np.concatenate([unpack(x) for x in table.column("counts").to_pylist()])
        names, first, where = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        total = np.bincount(where, own, len(names)).astype(np.int64)
        owner = np.zeros(len(own), bool)
        owner[first[total > 0]] = True
        held = np.concatenate([_unbits(x, len(k)) for x, k in zip(table.column("held").to_pylist(), keys)])
        needed = (np.bincount(where, held, len(names)) > 0) | (total > TOP)
        real = total[names != START] if words else total
        stats = np.concatenate([[real.sum(), (real > 0).sum()], count_counts(real)]).astype(np.int64)
        ends = np.cumsum([len(x) for x in keys])
        chunks, bucket = table.column("chunk").to_pylist(), key[0].as_py()
        rows = []
        for c, k, j in zip(chunks, keys, ends):
            at = where[j - len(k) : j]
            rows.append(("answer", c, pack(total[at]), _bits(owner[j - len(k) : j]), _bits(needed[at]), None, bucket))
        rows += [("totals", None, pack(stats), None, None, None, bucket), ("counts", None, pack(total[total > 0]), None, None, pack_sorted(names[total > 0]), bucket)]
        return _answers(rows)

    return asked.groupBy("bucket").applyInArrow(add, ANSWER)


def looked_up(asked: DataFrame, table: DataFrame) -> DataFrame:
    """The answers that a store's counts (bucket, keys, counts) give; nobody owns anything."""

    def find(key, asked, table):
        names = np.concatenate([np.zeros(0, np.uint64), *(unpack_sorted(x) for x in table.column("keys").to_pylist())])
        total = np.append(np.concatenate([np.zeros(0, np.int64), *(unpack(x) for x in table.column("counts").to_pylist())]), 0)
        rows = []
        for chunk, x in zip(asked.column("chunk").to_pylist(), map(unpack_sorted, asked.column("keys").to_pylist())):
            at = np.minimum(np.searchsorted(names, x), max(0, len(names) - 1))
            there = names[at] == x if len(names) else np.zeros(len(x), bool)
            none = _bits(np.zeros(len(x), bool))
            rows.append(("answer", chunk, pack(np.where(there, total[at], 0)), none, none, None, key[0].as_py()))
        return _answers(rows)

    return asked.groupBy("bucket").cogroup(table.groupBy("bucket")).applyInArrow(find, ANSWER)


def totals(answers: DataFrame) -> np.ndarray:
    """(tokens, types, counts of counts 0 ... TOP + 1): one short row a bucket."""
    out = np.zeros(4 + TOP, np.int64)
    for (x,) in answers.where("kind = 'totals'").select("counts").collect():
        out += unpack(bytes(x))
    return out


class Katz:
    """The numbers that all chunks share, from each order's totals."""

    def __init__(self, orders: list[np.ndarray], width: int, bits: int):
        self.orders, self.width, self.bits = orders, width, bits
        self.n, self.v = int(orders[0][0]), int(orders[0][1])
        self.d = [discounts(x[2:]) for x in orders]
        r = np.arange(TOP + 1)
        left = float((orders[0][2 : 3 + TOP] * r * (1 - self.d[0]))[1:].sum())
        self.total = self.n if left > 0 else self.n + 1
        self.unknown = (left if left > 0 else 1.0) / max(1, self.total)

    def word(self, c: np.ndarray) -> np.ndarray:
        """p(w), by the word's count."""
        d = np.where(c <= TOP, self.d[0][np.minimum(c, TOP)], 1.0)
        return np.where(c > 0, d * c / max(1, self.total), self.unknown)

    def weights(self, k: int, rare: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """For histories of order k n-grams, rows of: what the discounts leave of their counts; what the followers have of the order
        below, in discounted counts. rare: followers seen r times after h (r = 1 ... TOP); high: sum of the counts below of
        followers whose count below is more than TOP; low: followers with count r below."""
        r = np.arange(1, TOP + 1)
        return np.stack([(rare * (r * (1 - self.d[k - 1][1:]))).sum(axis=1), high + (low * (r * self.d[k - 2][1:])).sum(axis=1)])


def counted_in(k: int, c: Chunk, counts: list[np.ndarray], has_rare: list[np.ndarray], level: np.ndarray):
    """For the order k of a chunk: tokens that wait for their history (places), and whether for its denominator only."""
    own = c.levels[k - 1]
    there = np.flatnonzero(own.history >= 0)
    seen = there[counts[k - 2][own.history[there]] > 0]
    often = (level[seen] == k) & (counts[k - 1][own.at[seen]] > TOP) & ~has_rare[k - 1][own.history[seen]]
    wait = (level[seen] < k) | often
    return seen[wait], often[wait]


def first_scores(joined: DataFrame, model: Katz, orders: int) -> DataFrame:
    """kind 0: sums for histories, to buckets (keys; data: numbers). kind 1: a chunk's documents with all but what waits."""
    out = "kind int, level int, bucket int, chunk long, keys binary, data array<binary>, docs array<long>"

    def run(batches):
        for batch in small(batches, 1):
            for chunk, docs, *rest in zip(*(batch.column(i).to_pylist() for i in range(6 + orders))):
                c = Chunk(*rest[:4], orders, model.width)
                got = [sorted(x, key=lambda y: y["bucket"]) for x in rest[4:]]
                counts = [np.concatenate([unpack(y["counts"]) for y in x] or [np.zeros(0, np.int64)]) for x in got]
                owned, needed = ([np.concatenate([np.zeros(0, bool), *(_unbits(y[f], len(unpack(y["counts"]))) for y in x)]) for x in got] for f in ("owned", "needed"))
                words = counts[0][c.levels[0].at]
                # the longest order that each token's n-gram was seen in, and its probability there
                level, p = np.zeros(len(c.doc), np.int64), model.word(words)
                has_rare = [np.zeros(0, bool)]
                for k in range(2, orders + 1):
                    own, n = c.levels[k - 1], counts[k - 1]
                    there = np.flatnonzero(own.at >= 0)
                    there = there[n[own.at[there]] > 0]
                    x = n[own.at[there]]
                    level[there] = k
                    p[there] = np.where(x <= TOP, model.d[k - 1][np.minimum(x, TOP)], 1.0) * x / np.maximum(counts[k - 2][own.history[there]], 1)
                    has_rare.append(np.bincount(own.history[own.some[(n > 0) & (n <= TOP)]], minlength=len(c.levels[k - 2].keys)) > 0)
                score = np.bincount(c.doc, np.log10(np.maximum(p, 1e-300)), len(docs))
                base = np.bincount(c.doc, np.log10((words + 1) / (model.n + model.v + 1)), len(docs))
                known = np.bincount(c.doc, words > 0, len(docs)).astype(np.int64)
                waits = {k: counted_in(k, c, counts, has_rare, level) for k in range(2, orders + 1)}
                need = {k: np.zeros(len(c.levels[k - 2].keys), bool) for k in waits}
                shorter = {}
                for k in range(orders, 1, -1):
                    own = c.levels[k - 1]
                    need[k][own.history[waits[k][0]]] = True
                    if k > 2:  # a weight needs the denominator of the shorter history
                        there = np.flatnonzero(own.history >= 0)
                        shorter[k] = np.zeros(len(need[k]), np.int64)
                        shorter[k][own.history[there]] = c.levels[k - 2].history[there]
                        ask_for = shorter[k][need[k]]
                        need[k - 1][ask_for[~has_rare[k - 2][ask_for]]] = True
                rows, data = [], [pack(c.lens), pack(c.held.astype(np.int64)), pack(known), pack(base.view(np.int64)), pack(score.view(np.int64))]
                for k in range(2, orders + 1):
                    own, names = c.levels[k - 1], c.levels[k - 2]
                    # what this chunk's own n-grams add to the sums of their histories
                    mine = np.flatnonzero(owned[k - 1])
                    mine = mine[needed[k - 2][own.history[own.some[mine]]]]
                    h, n, low = own.history[own.some[mine]], counts[k - 1][mine], counts[k - 2][names.at[own.some[mine]]]
                    sends = need[k].copy()
                    sends[h] = True
                    go, h = np.flatnonzero(sends), (np.cumsum(sends) - 1)[h]
                    sums = [np.bincount(h, np.where(low > TOP, low, 0), len(go)).astype(np.int64)]
                    sums += [np.bincount(h[x == r], minlength=len(go)) for x in (n, low) for r in range(1, TOP + 1)]
                    sent, asks = names.keys[go], need[k][go]
                    rows += [(0, k, b, chunk, pack_sorted(sent[i:j]), [_bits(asks[i:j]), *(pack(x[i:j]) if x[i:j].any() else b"" for x in sums)], None) for b, i, j in parts(sent, model.bits, names.width)]
                    wanted = np.flatnonzero(need[k])
                    at, often = waits[k]
                    lower, lower_c = np.full(len(wanted), -1), np.zeros(len(wanted), np.int64)
                    if k > 2:
                        s = shorter[k][wanted]
                        asked = need[k - 1][s]
                        lower[asked] = np.searchsorted(np.flatnonzero(need[k - 1]), s[asked])
                        lower_c = counts[k - 3][s]
                    data += [pack(x.astype(np.int64)) for x in (c.doc[at], np.searchsorted(wanted, own.history[at]), often, lower, lower_c, counts[k - 2][wanted])]
                rows.append((1, 0, -1, chunk, None, data, docs))
                kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=["kind", "level", "bucket", "chunk", "keys", "data", "docs"])

    return joined.mapInArrow(run, out)


WEIGHTS = "chunk long, level int, bucket int, keys binary, weights array<binary>"


def _weights(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.binary()))
    return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 5, kinds)], names=["chunk", "level", "bucket", "keys", "weights"])


def _packed(weights: np.ndarray) -> list[bytes]:
    return [pack(np.ascontiguousarray(x).view(np.int64)) for x in weights]


def history_weights(sums: DataFrame, model: Katz) -> DataFrame:
    """For each level and bucket: the weights that each chunk needs, in its keys' order, and one row with chunk -2 (all keys and
    weights)."""

    def add(key, table):
        keys = [unpack_sorted(x) for x in table.column("keys").to_pylist()]
        data = table.column("data").to_pylist()
        every = np.concatenate([np.stack([unpack(y) if y else np.zeros(len(k), np.int64) for y in x[1:]], axis=1) for x, k in zip(data, keys)])
        names, where = np.unique(np.concatenate(keys), return_inverse=True)
        order = np.argsort(where, kind="stable")
        total = np.add.reduceat(every[order], np.searchsorted(where[order], np.arange(len(names))), axis=0)
        level, bucket = key[0].as_py(), key[1].as_py()
        got = model.weights(level, total[:, 1 : 1 + TOP], total[:, 0], total[:, 1 + TOP :])
        ends, rows = np.cumsum([len(x) for x in keys]), []
        for chunk, k, j, x in zip(table.column("chunk").to_pylist(), keys, ends, data):
            at = where[j - len(k) : j][_unbits(x[0], len(k))]
            if len(at):
                rows.append((chunk, level, bucket, None, _packed(got[:, at])))
        return _weights([*rows, (-2, level, bucket, pack_sorted(names), _packed(got))])

    return sums.groupBy("level", "bucket").applyInArrow(add, WEIGHTS)


def looked_up_weights(asked: DataFrame, table: DataFrame) -> DataFrame:
    """The same from a store's weights (level, bucket, keys, weights)."""

    def find(key, asked, table):
        names = np.concatenate([np.zeros(0, np.uint64), *(unpack_sorted(x) for x in table.column("keys").to_pylist())])
        got = [np.stack([unpack(y, np.float64) for y in x]) for x in table.column("weights").to_pylist()]
        rows = []
        for chunk, x in zip(asked.column("chunk").to_pylist(), map(unpack_sorted, asked.column("keys").to_pylist())):
            rows.append((chunk, key[0].as_py(), key[1].as_py(), None, _packed(got[0][:, np.searchsorted(names, x)])))
        return _weights(rows)

    return asked.groupBy("level", "bucket").cogroup(table.groupBy("level", "bucket")).applyInArrow(find, WEIGHTS)


def last_scores(joined: DataFrame, model: Katz, orders: int) -> DataFrame:
    def run(batches):
        for batch in small(batches, 1):
            for docs, data, got in zip(*(batch.column(i).to_pylist() for i in range(3))):
                lens, held, known, base, score = map(unpack, data[:5])
                score = score.view(np.float64).copy()
                below = None
                for k in range(2, orders + 1):
                    doc, place, often, lower, lower_c, count = map(unpack, data[6 * k - 7 : 6 * k - 1])
                    own = sorted((x for x in got or [] if x["level"] == k), key=lambda x: x["bucket"])
                    left, seen = (np.concatenate([np.zeros(0), *(unpack(x["weights"][i], np.float64) for x in own)]) for i in range(2))
                    under = np.full(len(left), float(max(1, model.total))) if k == 2 else np.maximum(lower_c, 1).astype(float)
                    if k > 2 and (lower >= 0).any():
                        under[lower >= 0] = below[lower[lower >= 0]]
                    # where the discounts leave nothing, the denominator is one larger
                    below = np.maximum(np.where(left > 0, count, count + 1), 1).astype(float)
                    weight = np.log10(np.where(left > 0, left, 1.0) / below) - np.log10(np.maximum(1.0 - seen / under, 1e-300))
                    if len(doc):
                        score += np.bincount(doc, np.where(often > 0, np.log10(np.maximum(count, 1) / below)[place], weight[place]), len(docs))
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(held > 0), pa.array(lens), pa.array(known), pa.array(np.full(len(docs), model.n)), pa.array(base.view(np.float64)), pa.array(score)], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return joined.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))


def _gather(df: DataFrame, name: str, *cols: str) -> DataFrame:
    return df.where("chunk >= 0").groupBy("chunk").agg(F.collect_list(F.struct("bucket", *cols)).alias(name))


def _with_answers(chunks: DataFrame, answers: list[DataFrame]) -> DataFrame:
    for k, x in enumerate(answers, 1):
        chunks = chunks.join(_gather(x.where("kind = 'answer'"), f"_{k}", "counts", "owned", "needed"), "chunk")
    return chunks.select("chunk", "docs", *_CHUNK, *[f"_{k}" for k in range(1, len(answers) + 1)])


def _finish(first: DataFrame, weights: DataFrame, model: Katz, orders: int) -> DataFrame:
    waiting = first.where("kind = 1").select("chunk", "docs", "data")
    return last_scores(waiting.join(_gather(weights, "got", "level", "weights"), "chunk", "left").select("docs", "data", "got"), model, orders)


@contextlib.contextmanager
def _bucketed(df: DataFrame, scratch: Scratch) -> Iterator[DataFrame]:
    """A table of the frame, bucketed by chunk, while it is used."""
    spark, name = df.sparkSession, f"talkmill_{uuid.uuid4().hex}"
    path, n = f"{shared_dir(spark)}/talkmill/{name}", partitions(spark)
    try:
        with lean(spark):
            df.repartition(n, "chunk").write.bucketBy(n, "chunk").option("path", path).option("compression", "zstd").saveAsTable(name)
        scratch.release()
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        scratch.delete(path)


def _first_pass(chunks: DataFrame, order: int, bits: int, own: str, every: bool, scratch: Scratch) -> tuple[DataFrame, Katz]:
    """(first_scores(), the model); writes the counts. every: whether weights of all histories are wanted."""
    spark = chunks.sparkSession
    width = min(64, int(chunks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]).bit_length() + SPARE)
    answers = []
    for k in range(1, order + 1):
        path = f"{own}/counts/order={k}"
        with lean(spark):
            answer(ask(chunks, k, bits, width, every), k == 1).write.partitionBy("kind", "bucket").option("compression", "zstd").parquet(path)
        answers.append(spark.read.schema(ANSWER).parquet(path))
        scratch.release()
    model = Katz([totals(x) for x in answers], width, bits)
    spark.createDataFrame([(k, x.tolist(), width, bits) for k, x in enumerate(model.orders, 1)], "level int, totals array<long>, width int, bits int").coalesce(1).write.parquet(f"{own}/model")
    first = scratch.keep(first_scores(_with_answers(chunks, answers), model, order))
    for k in range(1, order + 1):
        scratch.delete(f"{own}/counts/order={k}/kind=answer")
    return first, model


def katz_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, modulus: int = 7, remainder: int = 2, chunk_tokens: int = CHUNK, store: str | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; learns from the rows not held out.
    store: a path for the model's tables, with weights of all histories; by default they are in a folder below the shared one, with
    those that these documents need, and deleted in the end."""
    if order < 2:
        raise ValueError("order must be 2 at least")
    spark = docs.sparkSession
    scratch = Scratch(spark)
    own = store or f"{shared_dir(spark)}/talkmill/{uuid.uuid4().hex}"
    bits = bucket_bits(spark)
    with _bucketed(chunk_table(_rows(docs, doc_id, text), modulus, remainder, chunk_tokens), scratch) as chunks:
        first, model = _first_pass(chunks, order, bits, own, bool(store), scratch)
    scratch.release()
    weights = scratch.keep(history_weights(first.where("kind = 0").select("level", "bucket", "chunk", "keys", "data"), model))
    weights.where("chunk = -2").select("level", "bucket", "keys", "weights").write.partitionBy("level", "bucket").parquet(f"{own}/weights")
    scratch.release()
    out = scratch.keep(_finish(first, weights, model, order))
    scratch.drop(first, weights)
    if not store:
        scratch.delete(own)
    return out


def load_model(spark: SparkSession, store: str) -> Katz:
    rows = spark.read.parquet(f"{store}/model").orderBy("level").collect()
    return Katz([np.array(r.totals, np.int64) for r in rows], rows[0].width, rows[0].bits)


def score_stored(docs: DataFrame, store: str, doc_id: str = "doc_id", text: str = "text", modulus: int = 7, remainder: int = 2, chunk_tokens: int = CHUNK) -> DataFrame:
    """The scores of other documents by the tables in a store; held_out goes by the same rule, and changes nothing."""
    spark = docs.sparkSession
    scratch, model = Scratch(spark), load_model(spark, store)
    order = len(model.orders)
    chunks = scratch.keep(chunk_table(_rows(docs, doc_id, text), modulus, remainder, chunk_tokens))
    tables = [spark.read.schema(ANSWER).parquet(f"{store}/counts/order={k}").where("kind = 'counts'").select("keys", "counts", "bucket") for k in range(1, order + 1)]
    answers = [scratch.keep(looked_up(ask(chunks, k, model.bits, model.width), x)) for k, x in enumerate(tables, 1)]
    first = scratch.keep(first_scores(_with_answers(chunks, answers), model, order))
    weights = spark.read.schema("keys binary, weights array<binary>, level int, bucket int").parquet(f"{store}/weights")
    found = scratch.keep(looked_up_weights(first.where("kind = 0").select("level", "bucket", "chunk", "keys"), weights))
    out = scratch.keep(_finish(first, found, model, order))
    scratch.drop(chunks, *answers, first, found)
    return out


def op9_katz_scoring(spark, sf_dir: str) -> DataFrame:
    return katz_scores(documents(spark, sf_dir))
