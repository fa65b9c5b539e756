"""Quality rules: rule statistics of whole texts and an isolation forest over them.

Statistics are counted for every text. Two rules reject outright: fewer than `least_words` words, or more than
`most_repeats` percent of the words in five-word windows that occur twice or more in the text. The others pass to the
forest: each tree splits a random sample on random statistics at random values until points stand alone or the depth limit is reached; a document
whose path is short in most trees is unlike the sample. The score is 2 ** (-mean path / expected path), in (0, 1).

The forest's statistics are the shares of symbols, capitals and marks, and the mean length of words. Duplicate lines are only
counted, and repeated words only part of the rules: with their shares as further statistics, good rows spread so widely that the
forest told labelled rows apart far less well.

The forest is fitted on at most `sample` rows labelled good (picked by a hash of the id; with no labels at all, of all
rows). The threshold is calibrated on every labelled row that the rules pass: histograms of the score by label, added up
in Spark, and the threshold that best tells the labels apart among those that reject at most `most_good` of the good
rows. Where no row is labelled bad, the threshold rejects nothing good: it is the highest score of a good row.

Cases: null and empty texts have no words and are rejected; very long texts are counted whole; an empty table gives an
empty table; null ids match no label; rows that repeat each get a verdict, and repeated labels count each time; labels
that are null are left out; other columns of the input stay unless an output column has their name.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, UPPER, Scratch, documents, small, words_of

SYMBOLS, MARKS = b"#*$%&|<>", b"!?;:=+_~^@/\\"
UPPER_LETTERS = UPPER.encode()
LETTERS = (UPPER + LOWER).encode()
SPACES = " \t\n\x0b\x0c\r"
OTHERS = re.compile(r"[^\x00-\x7f]+")
LEAST_WORDS, MOST_REPEATS, WINDOW = 10, 20, 5
TREES, LEAF_SAMPLE, SAMPLE, MOST_GOOD, SEED, BINS = 200, 256, 20_000, 0.002, 7, 2000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = ("symbols", "upper", "marks", "word_length")


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words that lie in windows found twice or more in the text, the first finding included; exact, by ranks."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[str, int] = {}
    rank = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    code, size = rank[:n].copy(), len(ids)
    for i in range(1, window):
        # codes stay below 2**63: windows so far are numbered anew where they would not
        if size > 2**62 // max(1, len(ids)):
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
            size = n
        code = code * len(ids) + rank[i : i + n]
        size *= len(ids)
    _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(counts[inverse] > 1)
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, twice, 1)
    np.add.at(covered, twice + window, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    text = text or ""
    words = words_of(text)
    n, chars = len(words), sum(map(len, words))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    dup, repeats = len(lines) - len(set(lines)), repeated_words(words)
    ascii_ = text.encode("utf-8", "surrogatepass")
    symbols, marks, upper, letters = (len(ascii_) - len(ascii_.translate(None, some)) for some in (SYMBOLS, MARKS, UPPER_LETTERS, LETTERS))
    for c, k in Counter("".join(OTHERS.findall(text))).items():
        letters += k * c.isalpha()
        upper += k * c.isupper()
    k = max(1, n)
    shares = [symbols / k, upper / max(1, letters), marks / k, chars / k]
    return [n, chars, symbols, dup, repeats], shares


def with_statistics(docs: DataFrame, text: str = "text", keep_text: bool = False) -> DataFrame:
    """Adds the counts, the shares and base_failed; the text itself only goes on if asked for."""
    names = {*COUNTS, *SHARES, "base_failed", "score", "kept", "_text", *([] if keep_text else [text])}
    kept = docs.select(F.col(text).alias("_text"), *[F.col(f"`{c}`") for c in docs.columns if c not in names])
    schema = T.StructType([*kept.schema.fields[1:], *[T.StructField(c, T.LongType()) for c in COUNTS], *[T.StructField(c, T.DoubleType()) for c in SHARES]])

    def run(batches):
        for batch in small(batches):
            got = [statistics(t) for t in batch.column(0).to_pylist()]
            counts = np.array([x for x, _ in got], np.int64).reshape(-1, len(COUNTS))
            shares = np.array([x for _, x in got], float).reshape(-1, len(SHARES))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *map(pa.array, counts.T), *map(pa.array, shares.T)], names=schema.names)

    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATS * F.col("n_words"))
    return kept.mapInArrow(run, schema).withColumn("base_failed", failed)


def path_constant(n: np.ndarray | float) -> np.ndarray:
    """Mean path of an unsuccessful search in a binary tree of n points."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


class IsolationForest:
    """Trees as arrays: the statistic that a node splits (-1: a leaf), where, its left child (the right one follows), and path length at a leaf."""

    def __init__(self, points: np.ndarray, trees: int = TREES, leaf_sample: int = LEAF_SAMPLE, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.size = min(leaf_sample, len(points))
        limit = int(np.ceil(np.log2(max(2, self.size))))
        # splits reach beyond the rows of a node by the range of a statistic over the sample, so that values which no good
        # row has are cut off early; a statistic without a range has 1
        wide = points.max(axis=0) - points.min(axis=0) if len(points) else None
        if wide is not None:
            wide[wide == 0] = 1.0
        self.trees = []
        for _ in range(trees if len(points) else 0):
            own = points[rng.choice(len(points), self.size, replace=False)]
            feature, cut, child, length = [-1], [0.0], [0], [0.0]
            todo = [(0, own, 0)]
            while todo:
                node, rows, depth = todo.pop()
                if depth >= limit or len(rows) <= 1:
                    length[node] = depth + float(path_constant(len(rows)))
                    continue
                f = int(rng.integers(points.shape[1]))
                at = float(rng.uniform(rows[:, f].min() - wide[f], rows[:, f].max() + wide[f]))
                left = rows[:, f] <= at
                feature[node], cut[node], child[node] = f, at, len(feature)
                for part in (rows[left], rows[~left]):
                    todo.append((len(feature), part, depth + 1))
                    feature.append(-1), cut.append(0.0), child.append(0), length.append(0.0)
            self.trees.append(tuple(map(np.array, (feature, cut, child, length))))

    def score(self, points: np.ndarray) -> np.ndarray:
        if not self.trees or not len(points):
            return np.zeros(len(points))
        total = np.zeros(len(points))
        for feature, cut, child, length in self.trees:
            node = np.zeros(len(points), np.int64)
            moving = np.flatnonzero(feature[node] >= 0)
            while len(moving):
                at = node[moving]
                node[moving] = child[at] + (points[moving, feature[at]] > cut[at])
                moving = moving[feature[node[moving]] >= 0]
            total += length[node]
        return 2.0 ** (-(total / len(self.trees)) / max(1e-9, float(path_constant(self.size))))


def best_threshold(bins: pd.DataFrame, most_good: float = MOST_GOOD) -> float:
    """bins: bin, good (boolean), n. A document is rejected if its score reaches the threshold."""
    good, bad = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for b, is_good, n in bins.itertuples(index=False):
        (good if is_good else bad)[int(b)] += n
    lost = np.cumsum(good[::-1])[::-1] / max(1.0, good.sum())
    found = np.cumsum(bad[::-1])[::-1] / max(1.0, bad.sum())
    if not bad.sum():
        return (int(np.max(np.flatnonzero(good), initial=-1)) + 1) / BINS if good.sum() else 1.1
    gain = np.where(lost <= most_good, found - lost, -1.0)
    return int(len(gain) - 1 - gain[::-1].argmax()) / BINS if gain.max() > 0 else 1.1


class Rules:
    """A fitted forest and its threshold."""

    def __init__(self, forest: IsolationForest, threshold: float):
        self.forest, self.threshold = forest, threshold


def _scorer(spark, forest: IsolationForest):
    table = spark.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(table.value.score(np.column_stack([c.to_numpy(float) for c in columns])))

    return score(*SHARES)


def fit(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id", trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> Rules:
    """stats: from with_statistics, best written beforehand. labels: doc_id, quality (1 good, 0 bad)."""
    spark = stats.sparkSession
    known = labels.where("doc_id is not null and quality is not null").select(F.col("doc_id").alias("_labelled"), (F.col("quality") == 1).alias("_good"))
    passed = stats.where(~F.col("base_failed")).select(F.col(doc_id).alias("_id"), *SHARES)
    labelled = passed.join(known, F.col("_id") == F.col("_labelled"))
    pick = lambda df: df.orderBy(F.xxhash64(F.lit(seed), "_id"), *SHARES).limit(sample).select(*SHARES).toPandas().to_numpy(float)
    points = pick(labelled.where("_good"))
    if not len(points):
        points = pick(passed)
    forest = IsolationForest(points, trees, LEAF_SAMPLE, seed)
    bins = labelled.select("_good", F.floor(_scorer(spark, forest) * BINS).alias("bin")).groupBy("bin", "_good").agg(F.count("*").alias("n")).select("bin", F.col("_good").alias("good"), "n").toPandas()
    return Rules(forest, best_threshold(bins))


def judge(stats: DataFrame, rules: Rules) -> DataFrame:
    """Adds score and kept in place of the shares."""
    out = stats.withColumn("score", _scorer(stats.sparkSession, rules.forest))
    return out.withColumn("kept", ~F.col("base_failed") & (F.floor(F.col("score") * BINS) < F.lit(round(rules.threshold * BINS)))).drop(*SHARES)


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    # a row of numbers for each document, which the result is made from
    stats = Scratch(spark).keep(with_statistics(documents(spark, sf_dir).select("doc_id", "text")))
    rules = fit(stats, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(stats, rules).select("doc_id", *COUNTS, "base_failed", "kept", "score")
