"""Generation: for each topic, calls in a row until its quota is met."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from talkmill.functions.text import fill
from talkmill.sources.config import Api

from . import transport

PARTS = 64
OUT = "topic_idx int, topic string, seq int, batch_no int, malformed int, messages array<struct<role: string, content: string>>, error string"


def valid(example: Any) -> bool:
    messages = example.get("messages") if isinstance(example, dict) else None
    if not isinstance(messages, list) or len(messages) < 2:
        return False
    return all(isinstance(m, dict) and isinstance(m.get("role"), str) and isinstance(m.get("content"), str) and m["content"].strip() for m in messages[:2]) and all(
        isinstance(m, dict) and isinstance(m.get("role"), str) and isinstance(m.get("content"), str) for m in messages[2:]
    )


def topic_examples(cfg: Api, send: transport.Transport, topic: str, count: int, max_rounds: int, sleep: Callable[[float], None]) -> tuple[list[tuple[int, list[dict]]], int]:
    """((batch number, messages) up to the quota, number of malformed examples). Asks for what is missing, at most a batch at
    a time; a failed call ends the topic with what there is; so do max_rounds calls."""
    found: list[tuple[int, list[dict]]] = []
    malformed = 0
    for batch in range(1, max_rounds + 1):
        if len(found) >= count:
            break
        ask = fill(cfg.prompt, n=min(cfg.batch_size, count - len(found)), topic=topic)
        reply = transport.call(cfg, send, [{"role": "user", "content": ask}], sleep)
        if not reply.ok:
            break
        got = reply.value if isinstance(reply.value, list) else []
        good = [[{"role": m["role"], "content": m["content"]} for m in x["messages"]] for x in got if valid(x)]
        malformed += len(got) - len(good)
        found += [(batch, m) for m in good]
    return found[:count], malformed


def generate(topics: DataFrame, cfg: Api, send: transport.Transport, max_rounds: int = 100, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """topics: topic_idx, topic, count. One row an example, in topic order by (topic_idx, seq); a topic that raises has one row
    with its error instead. A row with neither messages nor error reports a topic without examples."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows: list[tuple] = []
            for at, topic, count in frame[["topic_idx", "topic", "count"]].itertuples(index=False):
                try:
                    found, bad = topic_examples(cfg, send, topic, int(count), max_rounds, sleep)
                except Exception as e:  # noqa: BLE001  one topic's failure is its own
                    rows.append((at, topic, None, None, None, None, str(e)))
                    continue
                rows += [(at, topic, k, b, bad, m, None) for k, (b, m) in enumerate(found)] or [(at, topic, None, None, bad, None, None)]
            yield pd.DataFrame(rows, columns=["topic_idx", "topic", "seq", "batch_no", "malformed", "messages", "error"]).astype({"seq": "Int32", "batch_no": "Int32", "malformed": "Int32"})

    return topics.repartition(cfg.workers(), "topic_idx").mapInPandas(run, OUT)


def within_quota(rows: DataFrame, quotas: DataFrame, group: str, order: str, count: str = "count") -> DataFrame:
    """The first rows of each group, as many as its quota says. A group is first cut to its quota in each of PARTS parts, so that no
    task sees all rows of a hot one."""
    own = rows.join(quotas.select(group, F.col(count).alias("_quota")), group).withColumn("_part", F.pmod(F.xxhash64(order), F.lit(PARTS)))
    near = own.withColumn("_k", F.row_number().over(W.partitionBy(group, "_part").orderBy(order))).where("_k <= _quota")
    return near.withColumn("_k", F.row_number().over(W.partitionBy(group).orderBy(order))).where("_k <= _quota").drop("_k", "_quota", "_part")
