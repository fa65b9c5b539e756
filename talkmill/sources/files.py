"""Files through Hadoop's file systems, so that any store which Spark reads will do."""

from __future__ import annotations

import fnmatch
import tempfile

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the context's checkpoint folder. Where neither is set, a
    folder of this machine, which only a local master can use."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where
    have = spark.sparkContext._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="talkmill-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def resolved(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    return fs.resolvePath(p).toString() if fs.exists(p) else fs.makeQualified(p).toString()


def listed(spark: SparkSession, folder: str, pattern: str = "*.jsonl") -> list[str]:
    """The folder's entries that match, hidden ones included, sorted by name as Python sorts; [] if there is no folder."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(p)]
    return [f"{folder.rstrip('/')}/{n}" for n in sorted(n for n in names if fnmatch.fnmatchcase(n, pattern))]


def without(spark: SparkSession, paths: list[str], own: str) -> list[str]:
    """All but one's own output, by resolved path."""
    mine = resolved(spark, own)
    return [x for x in paths if resolved(spark, x) != mine]


def made(spark: SparkSession, folder: str) -> str:
    fs, p = _fs(spark, folder)
    fs.mkdirs(p)
    return folder


def removed(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def is_hidden(path: str) -> bool:
    """Spark's readers skip such names."""
    return path.rstrip("/").rsplit("/", 1)[-1].startswith(("_", "."))


def read_hidden(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()
