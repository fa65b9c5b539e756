"""Chat templates and tokenizer reports."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill.functions.text import assessment, efficiency

#: Templates by name: what stands before and after a message's role and content.
TEMPLATES: dict[str, tuple[str, str, str]] = {"chatml": ("<|im_start|>", "\n", "<|im_end|>\n"), "plain": ("", ": ", "\n")}


def rendered(messages: Column, template: str = "chatml") -> Column:
    """The messages as one text, without an opening for a reply."""
    before, between, after = TEMPLATES[template]
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit(before), F.coalesce(m["role"], F.lit("")), F.lit(between), F.coalesce(m["content"], F.lit("")), F.lit(after))), "")


def token_counter(count: Callable[[list[str]], list[int]]):
    """A column function that counts tokens with any tokenizer, in Arrow batches."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(count(texts.fillna("").tolist()), dtype="int32")

    return F.pandas_udf(run, "int")


def utf8_bytes(c: Column) -> Column:
    """What a byte-level tokenizer needs at most."""
    return F.octet_length(c)


def report(rows: DataFrame, label: str, text: str, tokens: Column) -> DataFrame:
    """(label, chars, tokens, ratio, assessment)."""
    out = rows.select(F.col(label).alias("label"), F.length(text).cast("int").alias("chars"), tokens.cast("int").alias("tokens"))
    return out.withColumn("ratio", efficiency(F.col("tokens"), F.col("chars"))).withColumn("assessment", assessment(F.col("ratio")))


#: The strings that a tokenizer is tried on.
TEST_STRINGS = [
    ("Pure Bengali script", "আজকে ঢাকায় অনেক জ্যাম ছিল, সত্যিই অনেক কষ্ট হয়েছে"),
    ("Colloquial Banglish", "bhai seriously কষ্ট হইছে, amader ki hobe 😭"),
    ("Romanized Bengali", "vai eta ki hoise, amio same rokom vabsi ekdom"),
    ("Heavy code-switching", "bhai এইটা দেইখা হাসতে হাসতে শেষ 💀 seriously amader ki hobe"),
    ("Pure English", "bhai seriously what is happening in this country today"),
    ("Political Bengali", "সরকারের দুর্নীতি আর সহ্য করা যাচ্ছে না, জনগণ এখন রাস্তায়"),
]


def too_long(rows: DataFrame, tokens: Column, most: int) -> DataFrame:
    """Rows that a trainer would cut."""
    return rows.withColumn("tokens", tokens.cast("int")).where(F.col("tokens") > most)
