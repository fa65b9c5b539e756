"""Chat examples: shape, validity, projection, numbering, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from talkmill.functions.text import has_text
from talkmill.schemas import EXAMPLE


#: Numbers of the order that are ranked together.
SPAN = 100_000


def conversations_to_examples(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", content: str = "text") -> DataFrame:
    """(key, messages): the turns of a conversation in order, as one example."""
    message = F.struct(F.col(order).alias("_o"), F.col(role).alias("role"), F.col(content).alias("content"))
    rows = turns.groupBy(key).agg(F.array_sort(F.collect_list(message)).alias("_m"))
    return rows.select(key, F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


def is_valid(messages: Column) -> Column:
    """At least two messages, the first two with a role and with text. Never null."""
    first, second = F.get(messages, F.lit(0)), F.get(messages, F.lit(1))
    good = (F.size(messages) >= 2) & first["role"].isNotNull() & second["role"].isNotNull() & has_text(first["content"]) & has_text(second["content"])
    return F.coalesce(good, F.lit(False))


def is_valid_json(value: Column) -> Column:
    """The same for a line of JSON, where roles and contents must be strings rather than be read as such."""
    v = F.try_parse_json(value)
    kind = lambda path: F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    text = lambda path: F.try_variant_get(v, path, "string")
    good = F.lit(True)
    for i in (0, 1):
        at = f"$.messages[{i}]"
        good = good & F.coalesce(kind(f"{at}.role") == "STRING", F.lit(False)) & F.coalesce(kind(f"{at}.content") == "STRING", F.lit(False)) & has_text(text(f"{at}.content"))
    return good


def project(messages: Column) -> Column:
    """Only role and content of every message."""
    return F.transform(messages, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))


def read_examples(rows: DataFrame, value: str = "value") -> DataFrame:
    """Adds messages, read from lines of JSON."""
    return rows.withColumn("messages", F.from_json(value, EXAMPLE)["messages"])


def post(messages: Column) -> Column:
    return F.get(messages, F.lit(0))["content"]


def comment(messages: Column) -> Column:
    return F.get(messages, F.lit(1))["content"]


def numbered(rows: DataFrame, file: str, order: str, name: str = "seq") -> DataFrame:
    """The number of each row in its file by a number that orders them, from 0; counted in ranges of that number, so that no task sees
    all rows of a large file."""
    span = F.floor(F.col(order) / SPAN)
    near = rows.withColumn("_span", span)
    sizes = near.groupBy(file, "_span").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(file).orderBy("_span").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    own = near.withColumn("_own", F.row_number().over(W.partitionBy(file, "_span").orderBy(order)))
    out = own.join(sizes.select(F.col(file).alias("_file"), F.col("_span").alias("_s"), before.alias("_before")), F.col(file).eqNullSafe(F.col("_file")) & F.col("_span").eqNullSafe(F.col("_s")))
    return out.withColumn(name, (F.col("_own") + F.col("_before") - 1).cast("long")).drop("_span", "_own", "_before", "_file", "_s")


def batched(rows: DataFrame, size: int, seq: str = "seq") -> DataFrame:
    """batch_idx, i (the place in the batch) and start (the number of the batch's first row)."""
    if size <= 0:
        raise ValueError("size must be positive")
    at = F.col(seq)
    return rows.withColumn("batch_idx", F.floor(at / size).cast("long")).withColumn("i", (at % size).cast("int")).withColumn("start", F.floor(at / size).cast("long") * size)


def batch_prompts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, start, n, prompt): the examples of a batch (i, messages) as the text that a judge gets."""
    entry = F.concat(F.lit("["), F.col("i").cast("string"), F.lit("] Post: "), F.coalesce(post(F.col("messages")), F.lit("")), F.lit("\n    Comment: "), F.coalesce(comment(F.col("messages")), F.lit("")))
    entries = F.array_sort(F.collect_list(F.struct(F.col("i"), entry.alias("x"))))
    out = rows.groupBy(*keys).agg(entries.alias("_e"), F.min("start").alias("start"), F.count("*").alias("n"))
    prompt = F.concat(F.lit("Check these training examples:\n\n"), F.array_join(F.transform("_e", lambda e: e["x"]), "\n\n"))
    return out.select(*keys, "start", "n", prompt.alias("prompt"))
