"""Mixing sources to target weights, with DataFrame operations only.

1. Pack: each source is one stream of its documents' words, in a fixed order, cut into blocks of `block` words (the last
   one may be shorter). A document holds the words [begin, begin + size) of its stream.
2. Draw: output shards of `slots` slots; each slot draws a source with probability in proportion to the targets, so that
   the counts of a shard are multinomial. What the draws of a source exceed or miss its number of blocks wanted by is
   settled: its last slots beyond that number go to the sources that miss some, so totals meet the targets.
3. Map: the j-th slot of a source reads the block that a pseudorandom permutation (swap-or-not, keyed by seed, source and
   pass) gives for j modulo the number of blocks; a new pass over the source is permuted anew.
4. Join slots and documents by source and block index.

Targets: weights in proportion, `times` times all words in total, at most `most` times a source's own words; the excess
is shared again by weight among the others until none is above.

Scale: words are counted once where the text lies; no text is shuffled by the counts. Offsets are prefix sums in buckets
of a hash, then over the buckets of a source, so a source with a third of all documents is spread over many tasks.
Everything is seeded; a rerun gives the same rows. The order of words in a stream follows a hash of the id, so that
nothing depends on how files are split.

Cases: null text has size 0 and takes nothing; a null source is a source of its own, last in order; rows that repeat are
documents of their own; an empty table gives an empty result; very long texts are counted whole, and lie in as many blocks as
they have words for; only the named columns are read, so that further columns with clashing names do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, Scratch, documents

WEIGHTS = (3.0, 1.0, 2.0)
BLOCK = 128
SLOTS = 4096
SEED = 20240229
#: Documents in a bucket of the prefix sums, about.
BUCKET = 500
ROUNDS = 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, times: float = 1.5, most: float = 2.0) -> DataFrame:
    """sources: source, source_size, n_docs (one row a source). Adds s (order number from 0) and target.

    A source is at its limit if limit / weight lies below the common level; sorted by that ratio, the level with the
    first k at their limit is (total - their limits) / (weights of the rest), and the right level is the largest.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("s") % len(weights) + 1).cast("int"))
    out = sources.withColumn("s", F.row_number().over(order) - 1).withColumn("_w", w).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    ever, before = W.partitionBy(), W.orderBy(F.col("_cap") / F.col("_w"), "s").rowsBetween(W.unboundedPreceding, -1)
    out = out.withColumn("_total", F.sum("source_size").over(ever) * F.lit(float(times))).withColumn("_all_w", F.sum("_w").over(ever))
    left = F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    out = out.withColumn("_level", left / (F.col("_all_w") - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
    out = out.withColumn("target", F.least("_cap", F.col("_w") * F.max("_level").over(ever)))
    return out.drop("_w", "_cap", "_total", "_all_w", "_level")


def uniform(*keys: Column) -> Column:
    """In [0, 1), from 52 bits of a hash of the keys."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 12).cast("double") / F.lit(float(1 << 52))


def permuted(x: Column, n: Column, *keys: Column) -> Column:
    """A pseudorandom permutation of 0 ... n - 1: rounds that swap x with (key - x) mod n or leave both."""

    def one(state: Column, i: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(*keys, i), n) - state, n)
        return F.when(F.xxhash64(*keys, i, F.greatest(state, partner)) % 2 == 0, state).otherwise(partner)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), one)


def in_ranges(points: DataFrame, value: str, ranges: DataFrame, lo: str, hi: str, cells: int, width: float | int) -> DataFrame:
    """Each point with the range [lo, hi) that its value lies in, by an equi-join on cells of the given width."""
    cell = lambda c: F.floor(F.col(c) / F.lit(width))
    spread = ranges.where(F.col(lo) < F.col(hi)).withColumn("_cell", F.explode(F.sequence(cell(lo), F.least(cell(hi), F.lit(cells).cast("long")))))
    return points.withColumn("_cell", cell(value)).join(spread, "_cell").where((F.col(value) >= F.col(lo)) & (F.col(value) < F.col(hi))).drop("_cell", lo, hi)


def pack(docs: DataFrame, sources: DataFrame, n_docs: int, doc_id: str, seed: int = SEED) -> DataFrame:
    """docs: doc_id, source, size and th (a hash of the text). Adds s, source_size, target, n_blocks, bucket, row (unique in the bucket) and begin."""
    near = docs.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    buckets = max(1, -(-n_docs // BUCKET))
    near = near.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id)), F.lit(buckets)))
    w = W.partitionBy("s", "bucket").orderBy(doc_id, "size", "th")
    near = near.withColumn("row", F.row_number().over(w)).withColumn("_inner", F.coalesce(F.sum("size").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    sums = docs.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id)), F.lit(buckets)))
    sums = sums.groupBy("s", "bucket").agg(F.sum("size").alias("_sum"))
    sums = sums.withColumn("_outer", F.coalesce(F.sum("_sum").over(W.partitionBy("s").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_sum")
    return near.join(sums, ["s", "bucket"]).withColumn("begin", F.col("_inner") + F.col("_outer")).drop("_inner", "_outer")


def draw_slots(spark: SparkSession, sources: DataFrame, total: int, keep, slots: int = SLOTS, seed: int = SEED) -> DataFrame:
    """One row a slot: shard, slot, s, pass, block. sources: s, target, n_blocks, wanted. keep: writes a table that is read more than once."""
    every = W.partitionBy()
    upto = W.orderBy("s").rowsBetween(W.unboundedPreceding, 0)
    shares = sources.where("target > 0").withColumn("_hi", F.sum("target").over(upto) / F.sum("target").over(every))
    shares = shares.withColumn("_lo", F.coalesce(F.lag("_hi").over(W.orderBy("s")), F.lit(0.0)))
    cells = 4096
    points = spark.range(total).select((F.col("id") / slots).cast("long").alias("shard"), (F.col("id") % slots).alias("slot"))
    points = points.withColumn("_u", uniform(F.lit(seed), F.col("shard"), F.col("slot")))
    drawn = in_ranges(points, "_u", shares.select("s", "_lo", "_hi"), "_lo", "_hi", cells, 1.0 / cells).drop("_u")
    drawn = keep(drawn)
    # the multinomial counts of the shards, and what came before in a source
    counts = drawn.groupBy("s", "shard").agg(F.count("*").alias("_count"))
    before = F.coalesce(F.sum("_count").over(W.partitionBy("s").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.withColumn("_start", before)
    own = F.row_number().over(W.partitionBy("shard", "s").orderBy("slot")) - 1
    numbered = drawn.withColumn("_own", own).join(starts.select("s", "shard", "_start"), ["s", "shard"]).withColumn("j", F.col("_own") + F.col("_start")).drop("_own", "_start")
    # settle: slots beyond a source's number go to sources that miss some
    got = sources.select("s", "n_blocks", "wanted").join(counts.groupBy("s").agg(F.sum("_count").alias("_n")), "s", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    past = W.orderBy("s").rowsBetween(W.unboundedPreceding, -1)
    over, under = F.greatest(F.col("_n") - F.col("wanted"), F.lit(0)), F.greatest(F.col("wanted") - F.col("_n"), F.lit(0))
    got = keep(got.withColumn("_over", F.coalesce(F.sum(over).over(past), F.lit(0))).withColumn("_lo", F.coalesce(F.sum(under).over(past), F.lit(0))).withColumn("_hi", F.col("_lo") + under))
    numbered = numbered.join(got.select("s", "wanted", "_over", "n_blocks"), "s")
    fine = numbered.where("j < wanted").select("shard", "slot", "s", "j", "n_blocks")
    spare = numbered.where("j >= wanted").select("shard", "slot", (F.col("_over") + F.col("j") - F.col("wanted")).alias("_rank"))
    width = max(1, total // 4096)
    moved = in_ranges(spare, "_rank", got.select("s", "n_blocks", "_n", "_lo", F.col("_lo").alias("_from"), "_hi"), "_lo", "_hi", total, width)
    moved = moved.select("shard", "slot", "s", (F.col("_n") + F.col("_rank") - F.col("_from")).alias("j"), "n_blocks")
    out = fine.unionByName(moved).withColumn("pass", (F.col("j") / F.col("n_blocks")).cast("long"))
    return out.withColumn("block", permuted(F.col("j") % F.col("n_blocks"), F.col("n_blocks"), F.lit(seed), F.col("s"), F.col("pass"))).drop("j", "n_blocks")


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, times: float = 1.5, most: float = 2.0, block: int = BLOCK, slots: int = SLOTS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(packed, taken). packed: a row a document with doc_id, source, th (xxhash64 of its text), size, source_size, target, s,
    bucket, row, begin. taken: a row for each block that a slot reads and document in it: shard, slot, s, pass, block, bucket,
    row, first, words (the document's words first ... first + words - 1)."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    sized = scratch.keep(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), F.xxhash64(F.col(text)).alias("th")))
    totals = scratch.keep(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")), weights, times, most))
    # a number of blocks for each source such that, at the mean length of its blocks, their words come nearest the target
    n_blocks = F.ceil(F.col("source_size") / F.lit(block))
    wanted = F.when(F.col("source_size") > 0, F.least(n_blocks * F.lit(float(most)), F.round(F.col("target") * n_blocks / F.col("source_size")))).otherwise(0.0).cast("long")
    plan = totals.withColumn("n_blocks", n_blocks).withColumn("wanted", wanted)
    n_docs, total = plan.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("wanted"), F.lit(0))).first()
    slots_read = draw_slots(spark, plan.select("s", "target", "n_blocks", "wanted"), total, scratch.keep, slots, seed)
    packed = pack(sized, plan.select("source", "s", "source_size", "target"), n_docs, "doc_id", seed)
    spans = packed.where("size > 0").select("s", "bucket", "row", "begin", "size")
    spans = spans.withColumn("block", F.explode(F.sequence((F.col("begin") / block).cast("long"), ((F.col("begin") + F.col("size") - 1) / block).cast("long"))))
    lo = F.greatest(F.col("begin"), F.col("block") * block)
    hi = F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * block)
    spans = spans.select("s", "block", "bucket", "row", (lo - F.col("begin")).alias("first"), (hi - lo).alias("words"))
    return packed, slots_read.join(spans, ["s", "block"])


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **parameters) -> DataFrame:
    """The mix as documents: for each document and pass over its source that takes words of it, a row with the columns of
    docs and the words taken, in text order with the white space behind them; a document that is taken whole is unchanged."""
    packed, taken = mix_sources(docs, doc_id, text, source, **parameters)
    spans = taken.groupBy("s", "bucket", "row", "pass").agg(F.sort_array(F.collect_list(F.struct("first", "words"))).alias("_spans"), F.sum("words").alias("_words"))
    spans = spans.join(packed.select("s", "bucket", "row", F.col("doc_id").alias("_id"), "th", "size"), ["s", "bucket", "row"])
    spans = spans.select("_id", F.col("th").alias("_hash"), (F.col("_words") == F.col("size")).alias("_whole"), "_spans")
    own = docs.withColumn("_th", F.xxhash64(F.col(text))).dropDuplicates([doc_id, "_th"])  # rows that repeat: each has spans
    joined = own.join(spans, F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_hash")))
    pieces = F.regexp_extract_all(F.col(text), F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    part = F.array_join(F.flatten(F.transform("_spans", lambda x: F.slice(pieces, (x["first"] + 1).cast("int"), x["words"].cast("int")))), "")
    new = F.when(F.col("_whole"), F.col(text)).otherwise(part)
    return joined.select(*[new.alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns])


def op5_mix_sources(spark, sf_dir: str) -> DataFrame:
    packed, taken = mix_sources(documents(spark, sf_dir))
    sums = taken.groupBy("s", "bucket", "row").agg(F.sum("words").alias("taken"))
    out = packed.join(sums, ["s", "bucket", "row"], "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source")
