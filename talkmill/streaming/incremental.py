"""Incremental refinement: only files that were not seen before, by Structured Streaming's file source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.functions.json import is_json
from talkmill.functions.text import has_text
from talkmill.operators import examples, judge as offline, refine
from talkmill.sources import files
from talkmill.sources.jsonl import with_seq


def refine_new_files(
    spark: SparkSession, folder: str, out: str, checkpoint: str, judge: Callable[[DataFrame], DataFrame] | None = None, size: int = 40, most_files: int = 1000
) -> None:
    """Refines the files of a folder that earlier runs have not, then stops. Rows go to out/refined and out/removed, one
    folder a batch of files. Verdicts are written first, to out/judged, and both outputs are made from them: a row is judged once,
    also where a batch is run again after its verdicts were written."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", most_files).load(folder)
    lines = lines.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("_at"), "value")

    def one(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        aside = f"{out}/judged/batch={batch_id}"
        if not files.exists(own, f"{aside}/_SUCCESS"):
            rows = numbered_lines(batch.withColumn("_id", F.monotonically_increasing_id())).where(has_text(F.col("value"))).where(is_json("value"))
            rows = examples.read_examples(with_seq(rows)).select("file", "seq", "value", "messages").persist()
            try:
                judge_ = judge or offline.offline_judge(examples.batched(rows, size))
                refine.refine(rows, judge_, size).write.mode("overwrite").parquet(aside)
            finally:
                rows.unpersist()
        done = own.read.parquet(aside)
        refine.kept(done).select("file", "seq", "value", "messages").write.mode("overwrite").parquet(f"{out}/refined/batch={batch_id}")
        refine.removed(done).write.mode("overwrite").parquet(f"{out}/removed/batch={batch_id}")

    query = lines.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def numbered_lines(rows: DataFrame) -> DataFrame:
    """line_no by the place of a line's split and its order there."""
    from pyspark.sql import Window as W

    own = F.row_number().over(W.partitionBy("file", "_at").orderBy("_id"))
    sizes = rows.groupBy("file", "_at").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy("file").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("_own", own).join(sizes.select("file", "_at", before.alias("_before")), ["file", "_at"]).withColumn("line_no", F.col("_own") + F.col("_before")).select("file", "line_no", "value")
