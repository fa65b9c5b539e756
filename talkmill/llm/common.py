"""Shared pieces of the llm operators: tables in the shared folder, word rules, hashing."""

from __future__ import annotations

import contextlib
import gc
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.sources import files

#: What a word is, in Java, RE2 and Python alike: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows and bytes that a function takes of an Arrow batch at once; Spark's batches may have 10,000 rows and 64 MB.
ARROW_ROWS, ARROW_BYTES = 500, 4 << 20

_SPACE = dict.fromkeys(map(ord, "\t\n\x0b\x0c\r"), " ")


def words_of(text: str | None) -> list[str]:
    """The words of a text (null: none). str.split() alone would also split at other Unicode spaces."""
    if not text:
        return []
    return [w for w in text.translate(_SPACE).split(" ") if w] if _odd(text) else text.split()


_ODD = re.compile("[\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")


def _odd(text: str) -> bool:
    return _ODD.search(text) is not None


def lower_ascii(text: str) -> str:
    """A-Z alone; bytes.lower() leaves other letters."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def crc_mod(doc_id: object, n: int) -> int:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return zlib.crc32(("" if doc_id is None else str(int(doc_id))).encode()) % n


def held_out(doc_id: Column, n: int, remainder: int) -> Column:
    """The same rule on a column."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n == remainder


def small(batches: Iterable[pa.RecordBatch], rows: int = ARROW_ROWS, size: int = ARROW_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in parts of so many rows, and of about so many bytes, at most: what Python makes of a part stays small."""
    for batch in batches:
        step = max(1, min(rows, batch.num_rows * size // max(1, batch.nbytes)))
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a folder of our own only where that is unset and the master
    is local."""
    return files.shared_root(spark)


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextlib.contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """While an action of ours runs, Spark's buffers for Python hold 4 MB, unless the session has its own size. Results don't depend on
    it."""
    if spark.conf.get(_BATCH, None) is not None:
        yield
        return
    spark.conf.set(_BATCH, "4m")
    try:
        yield
    finally:
        spark.conf.unset(_BATCH)


class Scratch:
    """Tables written to the shared folder: they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def keep(self, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        path = f"{shared_dir(self.spark)}/talkmill/{uuid.uuid4().hex}"
        writer = df.write.option("compression", "zstd")
        with lean(self.spark):
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        got = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(got)] = (path, got)
        return got

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing will read again."""
        for df in tables:
            path, _ = self.paths.pop(id(df), (None, None))
            if path:
                self.delete(path)

    def delete(self, path: str) -> None:
        files.removed(self.spark, path)


    def release(self) -> None:
        """Spark deletes a job's shuffle files once the driver has collected what refers to them; until then they fill the
        executors' disks. For steps between which much is shuffled. The scheduler refers to its last job, so a small one comes first."""
        self.spark.range(1).collect()
        gc.collect()
        self.spark._jvm.System.gc()

    def clear(self, *but: DataFrame) -> None:
        """Drop all tables but those that the result is read from."""
        kept = set(map(id, but))
        self.drop(*[df for k, (_, df) in list(self.paths.items()) if k not in kept])


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 arrays (the public splitmix64 constants)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def plain(value: object) -> object:
    """None for pandas' nulls."""
    return None if value is None or value is pd.NA or (isinstance(value, float) and value != value) else value


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def file_bytes(df: DataFrame) -> int:
    """What Spark's plan says the columns take, in the files where there are some."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bucket_bits(spark: SparkSession) -> int:
    """Leading bits of a hash that number the buckets: two to four a shuffle partition, 16 at least."""
    return max(4, (2 * partitions(spark) - 1).bit_length())


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
