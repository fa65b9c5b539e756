"""Document fingerprints: order MinHash.

The k-mers of a text (k code points) are numbered by occurrence, so that a repeated k-mer counts as often as it occurs.
Each of the m parts of a fingerprint has an ordering of all numbered k-mers; the l smallest of the text are selected, put
back into the order in which they stand in the text, and hashed as a tuple. Two texts agree in a part if they share those
k-mers and their order, so the share of parts that agree falls with edit distance.

The orderings are probes of a hash ring: all numbered k-mers are hashed to a ring once (a ring for each `per_ring`
probes), and the ordering of a probe goes round the ring from that probe's place. Each such ordering makes any k-mer of a
set the smallest with equal probability, as MinHash needs, and a sorted ring answers all probes by binary search: the
work is a sort of the k-mers, not m passes over them.

Texts shorter than k code points have themselves as the one k-mer; null counts as the empty text, whose fingerprint has
its own fixed value. Equal texts have equal fingerprints.

op4's next document: rows are dealt into ranges of (doc_id, hash of the text) with bounds that are rows of the table, and the row on
each bound goes to the range before it as well, so one shuffle of the texts gives each row its neighbour. Ranges hold about
RANGE bytes, one a partition; an id with more rows than that is split between hashes. Null ids come first; rows with the same
id are ordered by their text's hash, then their text. An empty table gives an empty result. Very long texts are
fingerprinted whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, documents, file_bytes, mix64, partitions, small

K, PARTS, SELECT, PER_RING = 8, 64, 2, 32
#: Texts with fewer k-mers are sorted by one number a k-mer.
SHORT = 1 << 16
#: Bytes of the input's files that a range holds, about.
RANGE = 32 << 20
#: Bounds of ranges go to all tasks; beyond so many, ranges grow.
MOST_RANGES = 100_000
SEED = 0x5EED0F0A
_BASE = np.uint64(0x9E3779B97F4A7C15)


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


class OrderMinHash:
    def __init__(self, k: int = K, parts: int = PARTS, select: int = SELECT, per_ring: int = PER_RING, seed: int = SEED):
        self.k, self.parts, self.select, self.per_ring = k, parts, select, per_ring
        rng = np.random.default_rng(seed)
        self.probes = rng.integers(0, 2**64, parts, dtype=np.uint64)
        self.salts = rng.integers(1, 2**64, -(-parts // per_ring) + 2, dtype=np.uint64)

    def kmers(self, points: np.ndarray) -> np.ndarray:
        """A hash of each k-mer, in text order."""
        k = min(self.k, len(points))
        n = len(points) - k + 1
        h = np.full(n, k, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(k):
                h = h * _BASE + points[i : i + n].astype(np.uint64)
        return mix64(h)

    def numbered(self, h: np.ndarray) -> np.ndarray:
        """The hash of each k-mer with the number of its occurrence so far."""
        n = len(h)
        if n < SHORT:
            # equal k-mers side by side, in text order: 48 bits of their hash above, the place below
            mask = np.uint64(SHORT - 1)
            both = np.sort((h & ~mask) | np.arange(n, dtype=np.uint64))
            at, group = (both & mask).astype(np.int64), both & ~mask
        else:
            at = np.argsort(h, kind="stable")
            group = h[at]
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        seen = np.empty(n, np.uint64)
        seen[at] = (np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))).astype(np.uint64)
        with np.errstate(over="ignore"):
            return mix64(h + (seen + np.uint64(1)) * self.salts[0])

    def signature(self, points: np.ndarray) -> np.ndarray:
        """m values of 32 bits."""
        out = np.empty(self.parts, np.uint32)
        if not len(points):
            return np.zeros(self.parts, np.uint32)
        x = self.numbered(self.kmers(points))
        n, l = len(x), min(self.select, len(x))
        bits = np.uint64(max(1, int(n - 1).bit_length()))
        mask = (np.uint64(1) << bits) - np.uint64(1)
        with np.errstate(over="ignore"):
            for ring in range(-(-self.parts // self.per_ring)):
                lo, hi = ring * self.per_ring, min(self.parts, (ring + 1) * self.per_ring)
                order = np.sort((mix64(x ^ self.salts[ring + 2]) & ~mask) | np.arange(n, dtype=np.uint64))
                at = np.searchsorted(order, self.probes[lo:hi])
                places = (order[(at[:, None] + np.arange(l)) % n] & mask).astype(np.int64)
                chosen = x[np.sort(places, axis=1)]
                h = np.arange(lo, hi).astype(np.uint64) + self.salts[1]
                for j in range(l):
                    h = mix64(h * _BASE + chosen[:, j])
                out[lo:hi] = (h >> np.uint64(32)).astype(np.uint32)
        return out

    @staticmethod
    def text(signature: np.ndarray) -> str:
        return signature.astype(">u4").tobytes().hex()

    @staticmethod
    def likeness(a: np.ndarray, b: np.ndarray) -> float:
        return float(np.mean(a == b))


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint", **parameters) -> DataFrame:
    """Adds the fingerprint, as hex, of each whole text; other columns stay, but for one with the new name."""
    kept = docs.select(F.col(text).alias("_text"), *[F.col(f"`{c}`") for c in docs.columns if c not in (out, "_text")])
    from pyspark.sql import types as T

    schema = T.StructType([*kept.schema.fields[1:], T.StructField(out, T.StringType())])

    def run(batches):
        omh = OrderMinHash(**parameters)
        for batch in small(batches):
            got = [omh.text(omh.signature(code_points(t))) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(got, pa.string())], names=schema.names)

    return kept.mapInArrow(run, schema)


def ranked(cut_i: np.ndarray, cut_h: np.ndarray):
    """A function of (id, hash): see rank_of; -2 for null ids, which come first."""

    @F.pandas_udf("long")
    def rank(i: pd.Series, h: pd.Series) -> pd.Series:
        out = np.full(len(i), -2, np.int64)
        if (there := i.notna().to_numpy()).any():
            out[there] = rank_of(cut_i, cut_h, i[there].to_numpy().astype(np.int64), h[there].to_numpy())
        return pd.Series(out)

    return rank


def bounds_of(ids: DataFrame, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """The first rows (id, hash) of about so many ranges of as many rows, in order. ids: i, h, written. What the driver gets are
    a few numbers a range."""
    known = ids.where("i is not null")
    q = known.agg(F.percentile_approx("i", [k / ranges for k in range(ranges)], 20 * ranges).alias("q"), F.min("i").alias("lo"), F.count("*").alias("n")).first()
    if q["lo"] is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cuts = {(x, -(1 << 63)) for x in {q["lo"], *q["q"]}}
    # an id with more rows than a range is cut between hashes, too
    often = F.broadcast(ids.sparkSession.createDataFrame(sorted({(x,) for x, _ in cuts if q["q"].count(x) > 1}), "i long"))
    for i, hashes in known.join(often, "i").groupBy("i").agg(F.percentile_approx("h", [k / ranges for k in range(ranges)], 20 * ranges).alias("q")).collect():
        cuts |= {(i, h) for h in hashes}
    first = ranked(*np.array(sorted(cuts), np.int64).T)
    rows = known.withColumn("_range", F.floor(first("i", "h") / 2)).groupBy("_range").agg(F.min(F.struct("i", "h")).alias("row")).select("row.*").collect()
    return tuple(np.array(sorted(map(tuple, rows)), np.int64).T)


def rank_of(ids: np.ndarray, hashes: np.ndarray, i: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Twice the last bound that is not above each row, and 1 if the row is that bound."""
    lo, hi = np.searchsorted(ids, i, "left"), np.searchsorted(ids, i, "right")
    last = hi - 1
    for k in np.unique(lo[hi > lo]):
        own = np.flatnonzero((lo == k) & (hi > lo))
        last[own] = k + np.searchsorted(hashes[k : hi[own[0]]], h[own], "right") - 1
    return 2 * last + ((ids[last] == i) & (hashes[last] == h))


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """(doc_id, text, _range, _border) with each range's rows together, sorted, ending with the first row of the next range."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("_h", F.xxhash64("text"))
    if ranges is None:
        ranges = min(MOST_RANGES, max(2 * partitions(spark), file_bytes(docs.select(doc_id, text)) // RANGE))
    scratch = Scratch(spark)
    ids = scratch.keep(rows.select(F.col("doc_id").alias("i"), F.col("_h").alias("h")))
    cut_i, cut_h = bounds_of(ids, ranges)
    null_ids = bool(ids.where("i is null").limit(1).count())
    scratch.drop(ids)
    first, last, rank = (-1 if null_ids else 0), len(cut_i) - 1, ranked(cut_i, cut_h)
    on_bound = F.when(F.col("_rank") < 0, F.lit(null_ids)).otherwise(F.col("_rank") % 2 == 1)
    before = F.when(F.col("_range") == first, F.lit(last)).otherwise(F.col("_range") - 1)
    out = rows.withColumn("_rank", rank("doc_id", "_h")).withColumn("_range", F.floor(F.col("_rank") / 2)).withColumn("_on", on_bound)
    own = F.struct(F.col("_range").alias("r"), F.lit(False).alias("b"))
    copies = F.when(F.col("_on"), F.array(own, F.struct(before.alias("r"), F.lit(True).alias("b")))).otherwise(F.array(own))
    out = out.withColumn("_copy", F.explode(copies)).select("doc_id", "text", "_h", F.col("_copy.r").alias("_range"), F.col("_copy.b").alias("_border"))
    out = out.repartitionById(max(1, last - first + 1), (F.col("_range") - first).cast("int"))
    return out.sortWithinPartitions("_range", "_border", F.col("doc_id").asc_nulls_first(), F.col("_h").asc_nulls_first(), F.col("text").asc_nulls_first()).drop("_h")


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """For each row: n_chars, the SHA-256 and fingerprint of its text edited with the next document's first half, and the likeness
    of its own fingerprint to that and to the next document's."""
    rows = with_next(docs, doc_id, text, ranges)

    def run(batches):
        omh = OrderMinHash()
        last = None  # the row that waits for its neighbour: (range, id, text, code points, signature)

        def done(row, text, points, signature):
            n = len(row[3])
            half = n // 2
            edited = np.concatenate([row[3][: n - half], points[:half]])
            own = omh.signature(edited)
            sha = hashlib.sha256(edited.tobytes().decode("utf-32-le").encode()).hexdigest()
            return row[1], n, sha, omh.text(row[4]), omh.text(own), omh.likeness(row[4], own), omh.likeness(row[4], signature)

        for batch in small(batches):
            out = []
            for doc_id, text, part, border in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if border and (last is None or last[0] != part):
                    continue  # a further row with the bound's id
                points = code_points(text)
                signature = omh.signature(points)
                if last is not None and last[0] == part:
                    out.append(done(last, text, points, signature))
                last = None if border else (part, doc_id, text, points, signature)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return rows.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op4_order_minhash(spark, sf_dir: str) -> DataFrame:
    return edited_fingerprints(documents(spark, sf_dir))
