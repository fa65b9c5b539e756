"""Mixing text sources: slices, standard form, weighted interleaving, shuffles, exact splits.

Global positions come from ranges: rows are dealt by their sort key into ranges, numbered within a range, and ranges by the
counts before them, so no task sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def uniform(seed: int, *keys: Column) -> Column:
    """In [0, 1): 52 bits of md5 of the seed and the keys; the same on any engine with md5."""
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def digest(seed: int, *keys: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def standard(df: DataFrame, column: str, source: str, key: str) -> DataFrame:
    """(source_id, row_key, text)."""
    return df.select(F.lit(source).alias("source_id"), F.col(key).cast("long").alias("row_key"), F.col(column).alias("text"))


def text_only(df: DataFrame, column: str) -> DataFrame:
    """One column, named text."""
    return df.select(F.col(column).alias("text"))


def numbered(rows: DataFrame, order: list[Column], buckets: int, bucket: Column, name: str = "pos") -> DataFrame:
    """A number from 1 in the order, where `bucket` (0 ... buckets - 1) does not fall in that order."""
    spread = rows.withColumn("_b", bucket)
    own = F.row_number().over(W.partitionBy("_b").orderBy(*order))
    counts = spread.groupBy("_b").agg(F.count("*").alias("_n"))
    before = counts.select("_b", F.coalesce(F.sum("_n").over(W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return spread.withColumn("_own", own).join(before, "_b").withColumn(name, (F.col("_own") + F.col("_before")).cast("long")).drop("_b", "_own", "_before")


#: Hexadecimal digits of a digest that are counted at once, and digests that may be gathered.
DIGITS, SORTED = 4, 100_000


def shuffled(rows: DataFrame, key: str, seed: int = 42, name: str = "pos") -> DataFrame:
    """Adds each row's place in a seeded shuffle, from 1; the same for any number of partitions. Buckets are the digest's
    first digits, so they are even and in order."""
    d = digest(seed, F.col(key))
    out = numbered(rows.withColumn("_d", d), [F.col("_d"), F.col(key)], 16**DIGITS, F.conv(F.substring("_d", 1, DIGITS), 16, 10).cast("int"), name)
    return out.drop("_d")


def cut_of(rows: DataFrame, key: str, n: int | float, seed: int) -> tuple[str, int, int, int]:
    """(the n-th digest of a seeded shuffle, how many of the rows with that digest are among the first n, how many there are, how
    many rows there are at all); n below 1 is a share of the rows, rounded up. Found by counts of digests' leading digits, in a
    few passes over the keys."""
    keys = rows.select(digest(seed, F.col(key)).alias("_d"))
    prefix, before, total = "", 0, None
    while True:
        own = keys.where(F.startswith("_d", F.lit(prefix))) if prefix else keys
        counts = sorted(tuple(r) for r in own.groupBy(F.substring("_d", len(prefix) + 1, DIGITS).alias("p")).agg(F.count("*").alias("n")).collect())
        if total is None:
            total = sum(c for _, c in counts)
            n = -int(-(n * total) // 1) if n < 1 else int(n)
            if not 0 < n < total:
                return ("" if n <= 0 else "g"), 0, 0, total  # before and after all digests
        for p, c in counts:
            if before + c >= n:
                prefix, left = prefix + p, c
                break
            before += c
        if left <= SORTED or len(prefix) == 32:  # a whole digest, or few of them
            own = keys.where(F.startswith("_d", F.lit(prefix))).groupBy("_d").agg(F.count("*").alias("n"))
            for last, c in sorted(tuple(r) for r in own.collect()):
                if before + c >= n:
                    return last, n - before, c, total
                before += c


def first_shuffled(rows: DataFrame, key: str, n: int | float, seed: int = 42, name: str = "_first") -> tuple[DataFrame, int]:
    """(the rows with a mark on exactly the first n of a seeded shuffle, how many rows there are). Rows stay where they are, but
    for those that share the key at which the first end, where only some of them are among the first."""
    last, some, ties, total = cut_of(rows, key, n, seed)
    d = digest(seed, F.col(key))
    if some == ties:
        return rows.withColumn(name, F.coalesce(d <= F.lit(last), F.lit(False))), total
    tied = rows.where(d == F.lit(last)).withColumn(name, F.row_number().over(W.orderBy(F.lit(1))) <= some)
    return rows.where(d != F.lit(last)).withColumn(name, d < F.lit(last)).unionByName(tied), total


def take(rows: DataFrame, n: int, on_short: str = "clip", pos: str = "pos") -> DataFrame:
    """Rows at places 1 ... n; fewer rows are an error if so asked."""
    if on_short == "error" and rows.count() < n:
        raise ValueError(f"fewer than {n} rows")
    return rows.where(F.col(pos) <= n)


def running(rows: DataFrame, by: str, order: str, value: Column, name: str, buckets: int | None = None) -> DataFrame:
    """The running sum of a value in each group, by buckets of the order (its own quantiles), so that a hot group is spread; as
    many as hold SORTED rows each, if not given. Best on keys alone: all columns go through windows."""
    buckets = buckets or max(64, min(4096, rows.count() // SORTED))
    edges = rows.agg(F.percentile_approx(order, [i / buckets for i in range(1, buckets)], 10_000)).first()[0] or []
    where = F.array(*[F.lit(x) for x in sorted(set(edges))]) if edges else F.array().cast("array<long>")
    spread = rows.withColumn("_b", F.size(F.filter(where, lambda e: e < F.col(order)))).withColumn("_v", value)
    own = F.sum("_v").over(W.partitionBy(by, "_b").orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    sums = spread.groupBy(by, "_b").agg(F.sum("_v").alias("_s"))
    before = sums.select(by, "_b", F.coalesce(F.sum("_s").over(W.partitionBy(by).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)).alias("_before"))
    return spread.withColumn("_own", own).join(before, [by, "_b"]).withColumn(name, F.col("_own") + F.col("_before")).drop("_b", "_v", "_own", "_before")


def interleaved(rows: DataFrame, weights: dict[str, float], source: str = "source_id", key: str = "row_key", seed: int = 42) -> DataFrame:
    """Adds arrival: independent exponential clocks, one a source at its weight. In order of arrival, each place is drawn from
    the sources that still have rows in proportion to their weights, and no row is drawn twice."""
    total = sum(weights.values())
    rate = F.create_map(*[F.lit(x) for k, w in weights.items() for x in (k, w / total)])
    step = -F.log(F.lit(1.0) - uniform(seed, F.col(source), F.col(key))) / F.element_at(rate, F.col(source))
    return running(rows.where(F.col(source).isin(*weights)), source, key, step, "arrival")


def strided(rows: DataFrame, weights: dict[str, float], source: str = "source_id", key: str = "row_key") -> DataFrame:
    """Adds arrival without chance: the k-th row of a source at (k - 1/2) / weight."""
    total = sum(weights.values())
    rate = F.create_map(*[F.lit(x) for k, w in weights.items() for x in (k, w / total)])
    out = running(rows.where(F.col(source).isin(*weights)), source, key, F.lit(1.0), "_k")
    return out.withColumn("arrival", (F.col("_k") - 0.5) / F.element_at(rate, F.col(source))).drop("_k")


def mixed(rows: DataFrame, weights: dict[str, float], n: int, order: str = "reference", seed: int = 42, on_short: str = "clip") -> DataFrame:
    """n rows of (source_id, row_key, text). "reference": interleaved without replacement, then shuffled, so that the weights
    don't tell which rows stay. "weighted": the first n in order of arrival, so that they do."""
    if order == "weighted":  # keys alone are ordered; texts are joined to those that stay
        first = interleaved(rows.select("source_id", "row_key"), weights, seed=seed).orderBy("arrival", "source_id", "row_key").limit(n)
        return rows.join(first.select("source_id", "row_key").distinct(), ["source_id", "row_key"], "left_semi")
    keyed = rows.withColumn("_key", F.concat_ws("|", "source_id", F.col("row_key").cast("string")))
    marked, total = first_shuffled(keyed, "_key", n, seed)
    if on_short == "error" and total < n:
        raise ValueError(f"fewer than {n} rows")
    return marked.where("_first").drop("_first", "_key")


def exact_split(rows: DataFrame, key: str, fraction: float | None, seed: int = 42) -> DataFrame:
    """Adds split: eval for exactly ceil(fraction * rows) rows, else train; all train without a fraction."""
    if not fraction or fraction <= 0:
        return rows.withColumn("split", F.lit("train"))
    marked, _ = first_shuffled(rows, key, min(fraction, 1.0), seed) if fraction < 1 else (rows.withColumn("_first", F.lit(True)), 0)
    return marked.withColumn("split", F.when(F.col("_first"), "eval").otherwise("train")).drop("_first")
