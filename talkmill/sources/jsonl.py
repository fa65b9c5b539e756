"""JSON-lines sources and sinks with explicit policies for malformed rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from talkmill.functions.json import compact, is_json
from talkmill.functions.text import has_text

from . import files

LINES = "file string, path string, line_no bigint, value string"


def scan_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, path, line_no, value): every physical line of the files, numbered from 1 in each.

    Ids of a split's lines follow each other, so a line's number is its id less the split's first, after the lines of the splits
    before it: only a count and an id of each split are gathered, and lines stay where they are read. Files whose names Spark
    skips are read on the driver; they are expected to be few and small."""
    plain = [p for p in paths if not files.is_hidden(p)]
    out = spark.createDataFrame([], LINES)
    if plain:
        where = F.col("_metadata.file_path")
        # a file that Spark wrote is a folder of parts: the folder's name counts, and parts follow each other by name
        name = F.coalesce(F.nullif(F.regexp_extract(where, r"([^/]+\.jsonl)/part-[^/]*$", 1), F.lit("")), F.col("_metadata.file_name"))
        raw = spark.read.text(plain).select(name.alias("file"), where.alias("path"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_id"), "value")
        sizes = raw.groupBy("file", "path", "_at").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
        before = F.coalesce(F.sum("_n").over(W.partitionBy("file").orderBy("path", "_at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        starts = sizes.select("file", "path", "_at", "_first", before.alias("_before"))
        lines = raw.join(starts, ["file", "path", "_at"])
        out = lines.select("file", "path", (F.col("_id") - F.col("_first") + 1 + F.col("_before")).alias("line_no"), "value")
    for p in paths:
        if files.is_hidden(p):
            text = re.split(r"\r\n|\r|\n", files.read_hidden(spark, p))
            rows = [(p.rsplit("/", 1)[-1], p, i, x) for i, x in enumerate(text[:-1] if text and not text[-1] else text, 1)]
            out = out.unionByName(spark.createDataFrame(rows, LINES))
    return out


def parsed(lines: DataFrame) -> DataFrame:
    """The lines that have text, with ok: whether Python's json module reads them."""
    return lines.where(has_text(F.col("value"))).withColumn("ok", is_json("value"))


def scan_jsonl(spark: SparkSession, paths: list[str], policy: str = "skip") -> tuple[DataFrame, DataFrame]:
    """(rows, malformed rows). With policy "fail", reading the rows raises at the first malformed one."""
    lines = parsed(scan_lines(spark, paths))
    if policy == "fail":
        message = F.concat(F.lit("malformed JSON in "), F.col("file"), F.lit(" line "), F.col("line_no").cast("string"))
        return lines.where(F.when(F.col("ok"), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))).drop("ok"), lines.where("false").drop("ok")
    return lines.where("ok").drop("ok"), lines.where("not ok").drop("ok")


def scan_folder(spark: SparkSession, folder: str, own: str | None = None, policy: str = "skip") -> tuple[DataFrame, DataFrame] | None:
    """All .jsonl files of a folder but one's own output; None if there is no folder or no file."""
    paths = files.listed(spark, folder)
    if own:
        paths = files.without(spark, paths, own)
    return scan_jsonl(spark, paths, policy) if paths else None


def scan_named(spark: SparkSession, path: str, policy: str = "skip") -> tuple[DataFrame, DataFrame] | None:
    """One file; None if it is missing."""
    return scan_jsonl(spark, [path], policy) if files.exists(spark, path) else None


def with_seq(rows: DataFrame) -> DataFrame:
    """seq: the number of a parsed row in its file, from 0, in line order; by ranges of lines, then within a range."""
    span = F.floor(F.col("line_no") / 100_000)
    near = rows.withColumn("_span", span)
    sizes = near.groupBy("file", "_span").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy("file").orderBy("_span").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    own = F.row_number().over(W.partitionBy("file", "_span").orderBy("line_no"))
    out = near.withColumn("_own", own).join(sizes.select("file", "_span", before.alias("_before")), ["file", "_span"])
    return out.withColumn("seq", F.col("_own") + F.col("_before") - 1).drop("_own", "_before", "_span")


def write_jsonl(df: DataFrame, path: str, order: list[str] | None = None, value: str | None = None, single: bool = False) -> None:
    """One JSON object a line. value: a column that holds the lines as they are. Ordered output is ranged over many files
    whose names sort; `single` is for results known to be small."""
    lines = df.select(*[F.col(c) for c in order or []], (F.col(value) if value else compact(F.struct(*df.columns))).alias("_line"))
    if order:
        lines = lines.coalesce(1).sortWithinPartitions(*order) if single else lines.orderBy(*order)
    elif single:
        lines = lines.coalesce(1)
    lines.select(F.col("_line").alias("value")).write.mode("overwrite").text(path)
