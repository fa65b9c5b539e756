"""Named datasets: a registry of where they lie and how they are read and written."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import files

_SPLIT = re.compile(r"^(\w+)(?:\[(?::(\d+))?\])?$")


def split_of(spec: str) -> tuple[str, int | None]:
    """("train", 60000) for train[:60000]; no number, no limit."""
    m = _SPLIT.match(spec)
    if not m:
        raise ValueError(f"a split like train or train[:1000] is expected, not {spec!r}")
    return m[1], int(m[2]) if m[2] else None


@dataclass
class Registry:
    """Readers by name; a name that is not registered is a folder of Parquet below `root`, by split and configuration."""

    root: str
    readers: dict[str, Callable[[SparkSession, str, str | None], DataFrame]] = field(default_factory=dict)

    def register(self, name: str, reader: Callable[[SparkSession, str, str | None], DataFrame]) -> None:
        self.readers[name] = reader

    def path(self, name: str, split: str = "train", config: str | None = None) -> str:
        return "/".join(x for x in (self.root.rstrip("/"), name, config, split) if x)

    def pull(self, spark: SparkSession, name: str, split: str = "train", config: str | None = None, order: str | None = None, key: str | None = None) -> DataFrame:
        """The rows of a split; a limit takes the first by `order`, else as they are stored, which a reader's rows are not: their
        first need an order. key: adds a column of that name that tells rows apart, by their places where they are stored."""
        part, limit = split_of(split)
        if name in self.readers:
            rows = self.readers[name](spark, part, config)
            if limit is not None:
                if order is None:
                    raise ValueError(f"the first rows of {name} need an order")
                rows = first_rows(rows, limit, order)
            return rows.withColumn(key, F.sha2(F.to_json(F.struct(*rows.columns)), 256)) if key else rows
        rows = spark.read.parquet(self.path(name, part, config))
        file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
        named = rows.withColumn(key, F.concat(file, F.lit("#"), row.cast("string"))) if key else rows
        if limit is None:
            return named
        if order:
            return first_rows(named, limit, order)
        # only a count of each file is gathered
        sizes = rows.select(file.alias("_file")).groupBy("_file").agg(F.count("*").alias("_n"))
        before = F.coalesce(F.sum("_n").over(W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        placed = named.withColumn("_file", file).withColumn("_row", row).join(sizes.select("_file", before.alias("_before")), "_file")
        return placed.where(F.col("_before") + F.col("_row") < limit).select(named.columns)

    def push(self, df: DataFrame, name: str, split: str = "train") -> str:
        df.write.mode("overwrite").parquet(path := self.path(name, split))
        return path


def first_rows(rows: DataFrame, n: int, key: str) -> DataFrame:
    """The n first rows by a key: each task keeps its n first before they meet."""
    return rows.orderBy(F.col(key).asc_nulls_first()).limit(n)


def require(spark: SparkSession, path: str) -> str:
    """The path, or FileNotFoundError."""
    if not files.exists(spark, path):
        raise FileNotFoundError(path)
    return path
