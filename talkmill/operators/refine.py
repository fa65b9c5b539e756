"""Refinement: batches of examples go to a judge; its verdicts split them into kept and removed."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill.functions.text import head, py_strip
from talkmill.schemas import VERDICT

from . import examples, transport

NO_REASON = "no reason given"


class BadReasons(ValueError):
    """A verdict removes examples but its reasons are no object."""


def read_verdict(raw: str | None, size: int) -> tuple[bool, list[int], dict[str, str]]:
    """(usable, indices to remove, reasons). Not an object, or `remove` not a flat list: not usable, and the batch stays.
    Indices are equal to places as Python's numbers are (2.0 and true count, "2" does not); others are passed over."""
    try:
        got = json.loads(raw) if raw is not None else None
    except ValueError:
        got = None
    if not isinstance(got, dict):
        return False, [], {}
    remove = got.get("remove", [])
    if not isinstance(remove, (list, dict, str)) or any(isinstance(x, (list, dict)) for x in remove):
        return False, [], {}
    places = sorted({int(x) for x in remove if isinstance(x, (int, float)) and x == x and abs(x) < 2**31 and x == int(x) and 0 <= x < size})
    reasons = got.get("reasons", {})
    if places and not isinstance(reasons, dict):
        raise BadReasons(f"reasons are {type(reasons).__name__}")
    reasons = reasons if isinstance(reasons, dict) else {}
    text = {str(p): _text(reasons[str(p)]) for p in places if str(p) in reasons}
    return True, places, text


def _text(x: Any) -> str:
    return x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)


def _verdicts(raw: pd.Series, size: pd.Series) -> pd.DataFrame:
    got = [read_verdict(r, int(n)) for r, n in zip(raw, size)]
    return pd.DataFrame({"ok": [g[0] for g in got], "remove": [g[1] for g in got], "reasons": [g[2] for g in got]})


def verdicts(raw: Column | str, size: Column | str) -> Column:
    """(ok, remove, reasons) of a reply for a batch of that size."""
    return F.pandas_udf(_verdicts, VERDICT)(raw, size)


def judged(batches: DataFrame, replies: DataFrame, keys: list[str]) -> DataFrame:
    """batches: keys, n; replies: keys, raw. (keys, ok, remove, reasons); a batch without a reply is not usable."""
    return batches.select(*keys, "n").join(replies.select(*keys, "raw"), keys, "left").withColumn("_v", verdicts("raw", "n")).select(*keys, "_v.*")


def split(rows: DataFrame, decided: DataFrame, keys: list[str]) -> DataFrame:
    """rows: keys, i, start. Adds removed, reason (of removed rows) and global_idx."""
    joined = rows.join(decided.select(*keys, "remove", "reasons"), keys, "left")
    removed = F.coalesce(F.array_contains(F.array_distinct("remove"), F.col("i")), F.lit(False))
    reason = F.coalesce(F.try_element_at("reasons", F.col("i").cast("string")), F.lit(NO_REASON))
    return joined.withColumn("removed", removed).withColumn("reason", F.when(F.col("removed"), reason)).withColumn("global_idx", F.col("start") + F.col("i")).drop("remove", "reasons")


def kept(rows: DataFrame) -> DataFrame:
    return rows.where("not removed").drop("removed", "reason")


def removed(rows: DataFrame) -> DataFrame:
    """As they are written aside; `value`, the example as it was read, comes along where it is there."""
    more = ["value"] if "value" in rows.columns else []
    return rows.where("removed").select("file", "batch_idx", "i", F.struct(F.col("messages")).alias("example"), "reason", "global_idx", *more)


def removed_lines(rows: DataFrame) -> DataFrame:
    """(file, batch_idx, i, line): removed rows as JSON, each example with all that it had when it was read."""
    rest = F.to_json(F.struct("reason", "global_idx"))
    line = F.concat(F.lit('{"example":'), py_strip(F.col("value")), F.lit(","), F.substring(rest, 2, 2**31 - 1))
    return rows.where("removed").select("file", "batch_idx", "i", line.alias("line"))


def removed_report(rows: DataFrame) -> DataFrame:
    """(file, global_idx, line): what a log says of removed rows, with the heads of post and comment."""
    m = F.col("messages")
    text = lambda c: F.coalesce(head(c), F.lit(""))
    line = F.concat(F.format_string("[%05d] removed: ", F.col("global_idx")), "reason", F.lit("\n  post: "), text(examples.post(m)), F.lit("\n  comment: "), text(examples.comment(m)))
    return rows.where("removed").select("file", "global_idx", line.alias("line"))


def retention(rows: DataFrame, by: str = "file") -> DataFrame:
    """(by, total, kept, removed, percent): percent is rounded down, 0 for nothing."""
    n, k = F.count("*"), F.count_if(~F.col("removed"))
    out = rows.groupBy(by).agg(n.alias("total"), k.alias("kept"), (n - k).alias("removed"))
    return out.withColumn("percent", F.when(F.col("total") > 0, F.floor(100 * F.col("kept") / F.col("total"))).otherwise(0).cast("long"))


def refine(rows: DataFrame, judge: Callable[[DataFrame], DataFrame], size: int = 40) -> DataFrame:
    """rows: file, seq, messages. judge: batches (file, batch_idx, start, n, prompt) to replies (file, batch_idx, raw).
    Every row, with removed, reason and global_idx."""
    keys = ["file", "batch_idx"]
    placed = examples.batched(rows, size)
    batches = examples.batch_prompts(placed, keys)
    return split(placed, judged(batches, judge(batches), keys), keys)


def model_judge(cfg, send: transport.Transport, sleep=None) -> Callable[[DataFrame], DataFrame]:
    """A judge that asks a language model; the configured prompt is sent as it is."""
    import time

    def judge(batches: DataFrame) -> DataFrame:
        asked = batches.withColumn("system", F.lit(cfg.prompt)).withColumnRenamed("prompt", "user")
        return transport.map_calls(asked, cfg, send, ["file", "batch_idx"], sleep=sleep or time.sleep)

    return judge


def pending(every: DataFrame, done: DataFrame, file: str = "file") -> DataFrame:
    """Files that have no result yet."""
    return every.select(file).distinct().join(done.select(file).distinct(), file, "left_anti")
