"""Exact structural dedup: the first row of each canonical form, by file and line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.functions.json import canonical


def first_of(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row of each key that comes first. An aggregate rather than a window: copies meet in the map tasks, so that a key
    with a third of all rows costs its task no more than the others."""
    fields = [*order, *[c for c in rows.columns if c not in order and c != key]]
    least = F.min_by(F.struct(*[F.col(c) for c in fields]), F.struct(*[F.col(c) for c in order]))
    return rows.groupBy(key).agg(least.alias("_first")).select(*[F.col(key) if c == key else F.col(f"_first.{c}").alias(c) for c in rows.columns])


def merged(rows: DataFrame, exact: bool = True) -> DataFrame:
    """rows: file, line_no, value (JSON). The first line of each canonical form, as it was written."""
    keyed = rows.withColumn("canon", F.sha2(canonical(F.col("value"), exact), 256))
    return first_of(keyed, "canon", ["file", "line_no"]).drop("canon")


def added_by_file(files: DataFrame, first: DataFrame, file: str = "file") -> DataFrame:
    """(file, added): how many first rows each file brought; 0 for files that brought none."""
    return files.select(file).distinct().join(first.groupBy(file).agg(F.count("*").alias("added")), file, "left").select(file, F.coalesce("added", F.lit(0)).cast("long").alias("added"))
