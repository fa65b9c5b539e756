"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document's set holds its distinct shingles of `width` lower-cased words. Two documents link if their sets' Jaccard
similarity is at least `percent`/100. Equal sets are one class from the start; all that follows is on classes.

Prefixes. All shingles have one fixed order: by their estimated number of documents, then by hash. If two sets of n and m
shingles link, they share at least o = percent / (100 + percent) * (n + m), and for every l the first n - o + l of the one
and m - o + l of the other share at least l shingles. Each class picks its l (1 to MOST_MATCH): reading the lists of a longer
prefix costs their estimated lengths, while at most (sum of those lengths) / l candidates can share l shingles, and each
costs a verification; the l of least cost wins. For a pair the smaller l of the two counts, over the part of both
prefixes that belongs to that l, so classes with different l meet in exactly the pairs that the filter lets through.

The estimate is a sketch over the shingles of all documents, whose counters never saturate: their number follows the input's
size up to 2 ** SKETCH_BITS, and beyond that a shingle stands out if it is more frequent than a counter's mean. It only decides
the order and the l, never what is found, so its errors at any size cost time, not links.

Large groups. Each class of a list with more than STAR classes is first compared with the list's pivot (the class with fewest
rare shingles: an original rather than a copy); what links with it forms components, and from then on only classes of
different components are compared, those outside a list's largest component with the others. For classes near the same
pivot, what only one of a class and the pivot has (its delta) tells all: only one of two classes has what only one of
their deltas has. So they link if their deltas share enough, and are joined on prefixes of the deltas; a group of g near
copies costs about g pairs, not their square, and no link between components is lost. Links inside a component can't change it.

Cases: null text and text without words: empty set, linked with nothing, component its own id. Fewer than `width`
words: the whole sequence is the one shingle. Rows with a null id have a null component and link with nothing. Rows that
repeat are equal sets. Only id and text are read; an empty table gives an empty result. Very long texts are taken whole: a
set is one array, of 8 bytes for each distinct shingle. Shingles are told apart by hashes of 64 bits, sets by 128; of two unlike
sets with the same first 64 bits one is taken for a class and the other's documents are linked with nothing.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, documents, file_bytes, lean, lower_ascii, mix64, partitions, small, words_of
from .components import connected

LEAST_BITS, SKETCH_BITS, SKETCH_BLOCKS = 18, 24, 256
MOST_MATCH, VERIFY_COST = 4, 8.0
#: Documents that a task counts before it hands its counts on.
SKETCHED = 30_000
STAR = 16
#: A class is near a pivot if at most this share of its shingles is not the pivot's.
NEAR = 0.35
#: Ids up to this number are sent to all executors to pick the sets to verify; beyond, they are joined.
BROADCAST_IDS = 1_000_000
REMEMBER = 150_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    def __init__(self, width: int):
        self.width, self.known = width, {}

    def hashes(self, text: str | None) -> np.ndarray:
        """The distinct shingles of a text, as sorted hashes."""
        words = words_of(lower_ascii(text)) if text else []
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > REMEMBER:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        k = min(self.width, len(words))
        n = len(words) - k + 1
        out = np.full(n, k, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(k):
                out = out * _BASE + h[i : i + n]
        return np.unique(mix64(out))


def set_id(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits in two numbers."""
    return tuple(np.frombuffer(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest(), "<i8").tolist())


class Sketch:
    """For each counter, how many (document, shingle) fall on it, in units of `scale`."""

    def __init__(self, bits: int, blocks: dict[int, bytes]):
        """blocks: counts by block, compressed; what is missing is 0."""
        counts = lambda x: np.frombuffer(zlib.decompress(x), np.uint32)
        self.bits, size = bits, (1 << bits) // SKETCH_BLOCKS
        self.scale = max((int(counts(x).max()) for x in blocks.values()), default=0) // 65536 + 1
        self.counts = np.zeros(1 << bits, np.uint16)
        total = 0
        for i, x in blocks.items():
            total += int(counts(x).sum(dtype=np.uint64))
            self.counts[i * size : (i + 1) * size] = counts(x) // np.uint32(self.scale)
        #: What an estimate has from other shingles.
        self.floor = total / (1 << bits)

    def of(self, h: np.ndarray) -> np.ndarray:
        return self.counts[(h >> np.uint64(64 - self.bits)).astype(np.int64)].astype(float) * self.scale


def sketch(rows: DataFrame, width: int, bits: int) -> Sketch:
    size, block = 1 << bits, (1 << bits) // SKETCH_BLOCKS

    def blocks(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in parts.values()], pa.binary())], names=["block", "counts"])

    def count(batches):
        shingler, total, docs = Shingler(width), np.zeros(size, np.uint16), 0
        own = total.reshape(SKETCH_BLOCKS, block)
        full = lambda: blocks({int(i): own[i].astype(np.uint32) for i in np.flatnonzero(own.any(axis=1))})
        for batch in small(batches, 250, 2 << 20):
            for text in batch.column(0).to_pylist():
                np.add.at(total, (shingler.hashes(text) >> np.uint64(64 - bits)).astype(np.int64), np.uint16(1))
            docs += batch.num_rows
            if docs >= SKETCHED:  # before 16 bits are full
                yield full()
                total[:], docs = 0, 0
        yield full()

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[i] = total.get(i, 0) + np.frombuffer(zlib.decompress(x), np.uint32).astype(np.uint64)
        yield blocks({i: np.minimum(x, (1 << 32) - 1).astype(np.uint32) for i, x in total.items()})

    found = rows.select("text").mapInArrow(count, "block int, counts binary").repartition(partitions(rows.sparkSession), "block")
    with lean(rows.sparkSession):
        return Sketch(bits, {i: bytes(x) for i, x in found.mapInArrow(add, "block int, counts binary").collect()})


def prefix_of(h: np.ndarray, df: np.ndarray, floor: float, percent: int, most_match: int = MOST_MATCH) -> tuple[np.ndarray, int, int]:
    """(the prefix of the chosen l, l, number of rare shingles). h: sorted hashes, df: their estimates, floor: what an estimate has from other shingles."""
    n = len(h)
    order = np.lexsort((h, df))
    one = n - -(-percent * n // 100) + 1
    excess = np.maximum(df[order].astype(float) - 1 - 2 * floor, 0.0)
    read = np.cumsum(excess)
    best, match = None, 1
    for l in range(1, most_match + 1):
        if one + l - 1 > n:
            break
        cost = read[one + l - 2] * (1 + VERIFY_COST / l)
        if best is None or cost < best:
            best, match = cost, l
    return h[order[: one + match - 1]], match, int((excess == 0).sum())


def classes(rows: DataFrame, width: int, percent: int, counts: Sketch) -> DataFrame:
    """(id, cid, other, n, rare, match, prefix) of each row of (id, text); cid and other are the set's 128 bits."""
    table = rows.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        shingler, df = Shingler(width), table.value
        for batch in small(batches, 250, 2 << 20):
            out = []
            for text in batch.column(1).to_pylist():
                h = shingler.hashes(text)
                if not len(h):
                    out.append((None, None, 0, 0, 0, None))
                    continue
                prefix, match, rare = prefix_of(h, df.of(h), df.floor, percent)
                out.append((*set_id(h), len(h), rare, match, prefix.view(np.int64)))
            cols = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()))))], names=["id", "cid", "other", "n", "rare", "match", "prefix"])

    return rows.mapInArrow(run, "id long, cid long, other long, n int, rare int, match int, prefix array<long>")


def sets_of(rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(cid, h) of the classes in `wanted` (cid, rep), read again from the texts."""
    spark = rows.sparkSession
    if wanted.count() <= BROADCAST_IDS:
        ids = spark.sparkContext.broadcast(np.unique(wanted.select("rep").toArrow().column("rep").to_numpy()))
    else:
        ids, rows = None, rows.join(wanted.select(F.col("rep").alias("id")).distinct(), "id", "left_semi")

    def run(batches):
        shingler = Shingler(width)
        for batch in small(batches, 250, 2 << 20):
            if ids is not None:
                have = np.isin(np.asarray(batch.column(0).fill_null(-1)), ids.value) & np.asarray(batch.column(0).is_valid())
                batch = batch.filter(pa.array(have))
            h = [shingler.hashes(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([set_id(x)[0] for x in h], pa.int64()), pa.array([x.view(np.int64) for x in h], pa.list_(pa.int64()))], names=["cid", "h"])

    return rows.mapInArrow(run, "cid long, h array<long>").join(wanted.select("cid"), "cid", "left_semi").dropDuplicates(["cid"])


def compared(pairs: DataFrame, known: DataFrame, rows: DataFrame, width: int, scratch: Scratch, delta: bool = False) -> DataFrame:
    """Pairs (a, b) of classes with o, the size of their sets' intersection; with `delta`, also what only one of both has, where
    at most NEAR of b's is beyond a's. known: cid, rep."""
    ids = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    wanted = scratch.keep(known.join(ids, "cid", "left_semi").select("cid", "rep"))
    sets = scratch.keep(sets_of(rows, wanted, width))
    left = pairs.join(sets.select(F.col("cid").alias("a"), F.col("h").alias("_a")), "a")
    both = left.join(sets.select(F.col("cid").alias("b"), F.col("h").alias("_b")), "b")
    out = both.withColumn("o", F.size(F.array_intersect("_a", "_b")))
    if delta:
        near = F.size("_b") - F.col("o") <= NEAR * F.size("_b")
        out = out.withColumn("delta", F.when(near, F.concat(F.array_except("_b", "_a"), F.array_except("_a", "_b"))))
    out = scratch.keep(out.drop("_a", "_b"))
    scratch.drop(sets, wanted)
    return out


def needed(n: str, m: str, percent: int) -> Column:
    """The smallest intersection of linked sets of n and m shingles."""
    return F.ceil(percent * (F.col(n) + F.col(m)) / (100 + percent))


def across(members: DataFrame, on: list[str], attributes: list[str]) -> DataFrame:
    """Pairs x, y of a list's members in different components, each once: those outside the component with most members of the
    list, with all others. members: on, cid, comp, attributes."""
    heads = members.groupBy(*on, "comp").agg(F.count("*").alias("_n")).groupBy(*on).agg(F.max(F.struct("_n", "comp")).alias("_top"), F.count("*").alias("_comps")).where("_comps > 1")
    placed = members.join(heads.select(*on, F.col("_top.comp").alias("_t")), on).withColumn("minor", F.col("comp") != F.col("_t")).drop("_t")
    names = ["cid", "comp", *attributes]
    x = placed.where("minor").select(*on, *[F.col(c).alias(f"x_{c}") for c in names])
    y = placed.select(*on, "minor", *[F.col(c).alias(f"y_{c}") for c in names])
    return x.join(y, on).where("x_comp <> y_comp and (not minor or x_cid < y_cid)").drop("minor")


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    bits = min(SKETCH_BITS, max(LEAST_BITS, (file_bytes(rows) // 4).bit_length()))
    every = scratch.keep(classes(rows, width, percent, sketch(rows, width, bits)))
    # one row a class: equal sets have equal prefixes
    own = every.where("cid is not null and id is not null").groupBy("cid").agg(F.min(F.struct("other", "id")).alias("_first"), F.min_by(F.struct("n", "rare", "match", "prefix"), "other").alias("_own"))
    members = scratch.keep(own.select("cid", "_first.other", F.col("_first.id").alias("rep"), "_own.*"))
    every_ = scratch.keep(every.select("id", "cid", "other", "n"))
    scratch.drop(every)
    scratch.release()
    known = members.select("cid", "rep")
    entries = members.select("cid", "n", "rare", "match", F.posexplode("prefix").alias("at", "sh"))
    lists = entries.groupBy("sh").agg(F.count("*").alias("size"), F.min(F.struct("rare", "cid", "n")).alias("pivot")).where("size > 1")
    met = scratch.keep(entries.join(lists, "sh"))
    fits = lambda a, b: f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"
    smaller = lambda df, x, y: df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()

    # 1. large lists: each class with the list's pivot
    stars = met.where(f"size > {STAR} and cid <> pivot.cid").where(fits("n", "pivot.n"))
    stars = scratch.keep(stars.select(F.col("pivot.cid").alias("a"), F.col("cid").alias("b"), F.col("pivot.n").alias("a_n"), F.col("n").alias("b_n")).distinct())
    starred = compared(stars, known, rows, width, scratch, True)
    links = scratch.keep(starred.where(F.col("o") >= needed("a_n", "b_n", percent)).select("a", "b"))
    comps = connected(links, scratch)
    scratch.release()
    comp = lambda df: df.join(comps.select(F.col("id").alias("cid"), "comp"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))

    # 2. what lists have in common, by prefixes: all pairs of small lists; in large ones those not both near the pivot
    near = starred.where("delta is not null").select(F.col("a").alias("p"), F.col("b").alias("cid")).withColumn("near", F.lit(True))
    placed = met.select("sh", "cid", "n", "match", "at", F.when(F.col("size") > STAR, F.col("pivot.cid")).alias("p"))
    placed = placed.join(near, ["p", "cid"], "left").withColumn("near", F.coalesce("near", F.coalesce(F.col("p") == F.col("cid"), F.lit(False))))
    placed = scratch.keep(comp(placed.drop("p")))
    scratch.drop(met)
    scratch.release()
    # a large list whose classes are all near its pivot has nothing to do here
    open_ = placed.groupBy("sh").agg(F.bool_and("near").alias("_all")).where("not _all").select("sh")
    pairs = across(placed.join(open_, "sh", "left_semi"), ["sh"], ["n", "match", "at", "near"]).where("not (x_near and y_near)").where(fits("x_n", "y_n"))
    l = F.least("x_match", "y_match")
    inside = (F.col("x_at") < F.col("x_n") - needed("x_n", "y_n", percent) + l) & (F.col("y_at") < F.col("y_n") - needed("x_n", "y_n", percent) + l)
    pairs = pairs.where(inside).select(F.least("x_cid", "y_cid").alias("a"), F.greatest("x_cid", "y_cid").alias("b"), l.alias("match"))
    pairs = pairs.groupBy("a", "b").agg(F.count("*").alias("shared"), F.first("match").alias("match")).where("shared >= match").select("a", "b")

    pairs = scratch.keep(pairs.join(smaller(stars, "a", "b"), ["a", "b"], "left_anti"))
    scratch.drop(placed, stars)
    scratch.release()
    sizes = members.select("cid", "n")
    sized = pairs.join(sizes.select(F.col("cid").alias("a"), F.col("n").alias("a_n")), "a").join(sizes.select(F.col("cid").alias("b"), F.col("n").alias("b_n")), "b")
    more = compared(sized, known, rows, width, scratch)
    links = scratch.keep(links.union(more.where(F.col("o") >= needed("a_n", "b_n", percent)).select("a", "b")))
    comps = connected(links, scratch)

    # 3. classes near the same pivot: what only one of a class and the pivot has tells all about two of them
    beyond = starred.where("delta is not null").select(F.col("a").alias("p"), F.col("b").alias("cid"), F.col("b_n").alias("n"), "delta")
    beside = near_pivots(scratch.keep(comp(beyond)), percent, scratch)
    scratch.drop(starred)
    if not beside.isEmpty():
        comps = connected(links.union(beside), scratch)

    # the smallest document of each component; then of each row's class
    where = comp(members.select("cid", "other", "rep"))
    least = where.groupBy("comp").agg(F.min("rep").alias("least"))
    final = scratch.keep(where.join(least, "comp").select("cid", "other", "least"))
    scratch.clear(every_, final)
    scratch.release()
    out = every_.join(final, ["cid", "other"], "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("least", "id")).alias("component_id"))


def near_pivots(beyond: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) between classes near the same pivot in different components. beyond: p, cid, n, delta (what only one of the class
    and the pivot has), comp.

    What only one of two classes has is what only one of their deltas has; so they link if the deltas share at least
    alpha = (d + e - most) / 2, where most is the largest number of shingles that only one of two linked sets of their sizes
    has. If alpha is below 1, both link with the pivot and are in one component. The prefixes are those of the join above."""
    sized = beyond.withColumn("d", F.size("delta"))
    mixed = sized.groupBy("p", "comp").agg(F.count("*").alias("_n")).groupBy("p").agg(F.max(F.struct("_n", "comp")).alias("_top"), F.count("*").alias("_c")).where("_c > 1")
    sized = scratch.keep(sized.join(mixed.select("p", F.col("_top.comp").alias("_t")), "p").withColumn("minor", F.col("comp") != F.col("_t")).drop("_t"))
    tokens = sized.withColumn("z", F.explode("delta")).drop("delta")
    lists = tokens.groupBy("p", "z").agg(F.count("*").alias("df"), F.bool_or("minor").alias("_minor")).where("df > 1")
    # shingles that no other delta has come first, unnumbered
    place = F.col("d") - F.row_number().over(W.partitionBy("p", "cid").orderBy(F.desc("df"), F.desc("z")))
    ordered = tokens.join(lists, ["p", "z"]).withColumn("at", place).where("_minor")
    x = ordered.where("minor").select("p", "z", *[F.col(c).alias(f"x_{c}") for c in ("cid", "comp", "n", "d", "at")])
    y = ordered.select("p", "z", "minor", *[F.col(c).alias(f"y_{c}") for c in ("cid", "comp", "n", "d", "at")])
    alpha = F.ceil((F.col("x_d") + F.col("y_d") - (F.col("x_n") + F.col("y_n") - 2 * needed("x_n", "y_n", percent))) / 2)
    l = F.least(alpha, F.lit(MOST_MATCH))
    inside = (F.col("x_at") < F.col("x_d") - alpha + l) & (F.col("y_at") < F.col("y_d") - alpha + l)
    met = x.join(y, ["p", "z"]).where("x_comp <> y_comp and (not minor or x_cid < y_cid)").where(f"100 * least(x_n, y_n) >= {percent} * greatest(x_n, y_n)").where(inside)
    found = scratch.keep(met.groupBy("p", "x_cid", "y_cid").agg(F.count("*").alias("shared"), F.first(l).alias("l"), F.first(alpha).alias("alpha")).where("shared >= l"))
    side = lambda s: sized.select("p", F.col("cid").alias(f"{s}_cid"), F.col("delta").alias(f"{s}_delta"))
    both = found.join(side("x"), ["p", "x_cid"]).join(side("y"), ["p", "y_cid"])
    links = scratch.keep(both.where(F.size(F.array_intersect("x_delta", "y_delta")) >= F.col("alpha")).select(F.least("x_cid", "y_cid").alias("a"), F.greatest("x_cid", "y_cid").alias("b")).distinct())
    return links


def op10_ngram_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


OP10_SQL = r"""
WITH RECURSIVE
words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS s FROM words),
classes AS (SELECT doc_id, s, len(s) AS n, min(doc_id) OVER (PARTITION BY list_sort(s)) AS rep FROM sets),
shingles AS (SELECT rep, n, unnest(s) AS z FROM (SELECT DISTINCT rep, n, s FROM classes WHERE doc_id = rep AND n > 0)),
links AS (SELECT a.rep AS x, b.rep AS y FROM shingles a JOIN shingles b ON a.z = b.z AND a.rep < b.rep GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(a, b) AS (SELECT DISTINCT rep, rep FROM classes UNION SELECT r.a, e.y FROM reach r JOIN edges e ON r.b = e.x),
least AS (SELECT a, min(b) AS least FROM reach GROUP BY a)
SELECT doc_id, n AS n_shingles, CASE WHEN n = 0 THEN doc_id WHEN doc_id IS NOT NULL THEN least END AS component_id FROM classes JOIN least ON a = rep
"""
