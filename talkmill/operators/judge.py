"""An offline judge: simple stand-ins for the rules that a model is asked to apply. Heuristics, not the model's opinion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .examples import comment, post

PLACEHOLDER = r"(?i)\[(post text|comment|natural banglish comment)\]"
ASSISTANT = r"(?i)\b(as an ai|language model|i can(no|')t assist|happy to help|feel free to|let me know if)\b"
BENGALI, LATIN = r"\p{InBengali}", r"[A-Za-z]"


def folded(c: Column) -> Column:
    """Lower case, one space for a run of anything but letters, digits and marks."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}\p{M}]+", " "))


def placeholder(messages: Column) -> Column:
    return F.coalesce(post(messages).rlike(PLACEHOLDER) | comment(messages).rlike(PLACEHOLDER), F.lit(False))


def overlap(messages: Column) -> Column:
    """Jaccard similarity of the words of post and comment."""
    a, b = F.array_distinct(F.split(folded(post(messages)), " ")), F.array_distinct(F.split(folded(comment(messages)), " "))
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def sounds_assistant(messages: Column) -> Column:
    return F.coalesce(comment(messages).rlike(ASSISTANT), F.lit(False))


def repeats_in_batch(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds repeat: an earlier example of the batch has the same folded texts."""
    same = F.concat_ws("\n", folded(post(F.col("messages"))), folded(comment(F.col("messages"))))
    return rows.withColumn("_same", same).withColumn("repeat", F.row_number().over(W.partitionBy(*keys, "_same").orderBy("i")) > 1).drop("_same")


def generic_comments(rows: DataFrame, least: int = 2) -> DataFrame:
    """(comment, posts): folded comments that answer at least so many different posts."""
    pairs = rows.select(folded(comment(F.col("messages"))).alias("comment"), folded(post(F.col("messages"))).alias("post"))
    return pairs.groupBy("comment").agg(F.countDistinct("post").alias("posts")).where(F.col("posts") >= least)


def pair_key(messages: Column) -> Column:
    return F.md5(F.concat_ws("\n", folded(post(messages)), folded(comment(messages))))


def boilerplate(rows: DataFrame, least: int = 2) -> DataFrame:
    """(pair, n): folded example texts that occur at least so often."""
    return rows.groupBy(pair_key(F.col("messages")).alias("pair")).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def unknown_rate(rows: DataFrame, words: DataFrame, id_: str, text: str) -> DataFrame:
    """(id, rate): the share of a text's distinct words that the vocabulary (word) lacks."""
    own = rows.select(id_, F.explode(F.array_distinct(F.split(folded(F.col(text)), " "))).alias("word")).where("word <> ''")
    known = own.join(words.select("word").distinct().withColumn("_k", F.lit(1)), "word", "left")
    return known.groupBy(id_).agg((F.sum(F.when(F.col("_k").isNull(), 1).otherwise(0)) / F.count("*")).alias("rate"))


def script(c: Column) -> Column:
    """bengali, roman, mixed or other, by the letters of a text."""
    b, l = F.regexp_count(c, F.lit(BENGALI)), F.regexp_count(c, F.lit(LATIN))
    return F.when((b > 0) & (l > 0), "mixed").when(b > 0, "bengali").when(l > 0, "roman").otherwise("other")


def script_mix(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, script, n, share)."""
    counts = rows.groupBy(*keys, script(F.col(text)).alias("script")).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(*keys)))


def sentences(c: Column) -> Column:
    """Runs of text that end in a sentence mark or the end."""
    return F.size(F.filter(F.split(c, r"[.!?।\n]+"), lambda s: s.rlike(r"\S")))


def near_repeats_in_batch(rows: DataFrame, keys: list[str], percent: int = 90) -> DataFrame:
    """(keys, near): places of examples whose words of post and comment are, to so many percent (Jaccard), those of an earlier
    example of the batch. A batch is as large as one request, so its examples may be compared with each other."""
    words = F.array_distinct(F.split(folded(F.concat_ws(" ", post(F.col("messages")), comment(F.col("messages")))), " "))
    batch = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("i", words.alias("w")))).alias("_b"))

    def like(x, y):
        return (x["i"] < y["i"]) & (100 * F.size(F.array_intersect(x["w"], y["w"])) >= percent * F.size(F.array_union(x["w"], y["w"])))

    near = F.filter("_b", lambda y: F.exists("_b", lambda x: like(x, y)))
    return batch.select(*keys, F.transform(near, lambda y: y["i"]).alias("near"))


def offline_reasons(
    rows: DataFrame, keys: list[str], near: int | None = None, unrelated: float | None = None, generic: int | None = None, often: int | None = None, words: DataFrame | None = None, unknown: float = 0.5
) -> DataFrame:
    """rows: keys, i, messages. Adds reason: why the offline judge would remove the example, or null; the first rule that fits.

    Placeholder text, repeats in a batch and an assistant's tone always count. Others where asked for: near (percent of words in
    common with an earlier example of the batch), unrelated (overlap of post and comment at most so large), generic (the comment
    answers at least so many different posts), often (the pair occurs at least so often), words (a table of known words, of
    which a text's distinct words may lack the share `unknown`)."""
    out, m = repeats_in_batch(rows, keys), F.col("messages")
    rules = [(placeholder(m), "placeholder text"), (F.col("repeat"), "duplicate in batch")]
    if near is not None:
        out = out.join(near_repeats_in_batch(rows, keys, near), keys, "left")
        rules.append((F.array_contains("near", F.col("i")), "nearly a duplicate in batch"))
    rules.append((sounds_assistant(m), "sounds like an assistant"))
    if unrelated is not None:
        rules.append((overlap(m) <= unrelated, "unrelated comment"))
    if generic is not None:
        out = out.withColumn("_comment", folded(comment(m))).join(generic_comments(rows, generic).select(F.col("comment").alias("_comment"), "posts"), "_comment", "left")
        rules.append((F.col("posts").isNotNull(), "generic comment"))
    if often is not None:
        out = out.withColumn("_pair", pair_key(m)).join(boilerplate(rows, often).select(F.col("pair").alias("_pair"), F.col("n").alias("_often")), "_pair", "left")
        rules.append((F.col("_often").isNotNull(), "boilerplate"))
    if words is not None:
        text = rows.select(F.struct(*keys, "i").alias("_row"), F.concat_ws(" ", post(m), comment(m)).alias("_text"))
        rates = unknown_rate(text, words, "_row", "_text")
        out = out.withColumn("_row", F.struct(*keys, "i")).join(rates, "_row", "left")
        rules.append((F.col("rate") > unknown, "unknown words"))
    reason = F.when(*_rule(*rules[0]))
    for rule in rules[1:]:
        reason = reason.when(*_rule(*rule))
    return out.withColumn("reason", reason).drop("repeat", "near", "_comment", "posts", "_pair", "_often", "_row", "rate")


def _rule(fits: Column, reason: str) -> tuple[Column, Column]:
    return F.coalesce(fits, F.lit(False)), F.lit(reason)


def offline_judge(placed: DataFrame, keys: list[str] | None = None, **rules):
    """A judge for refine(): replies made from the reasons above. placed: file, batch_idx, i, messages; rules: see
    offline_reasons."""
    keys = keys or ["file", "batch_idx"]

    def judge(batches: DataFrame) -> DataFrame:
        found = offline_reasons(placed, keys, **rules).where("reason is not null")
        place = F.struct("i", "reason")
        got = found.groupBy(*keys).agg(F.array_sort(F.collect_list(place)).alias("_r"))
        reply = F.to_json(F.struct(F.transform("_r", lambda r: r["i"]).alias("remove"), F.map_from_entries(F.transform("_r", lambda r: F.struct(r["i"].cast("string"), r["reason"]))).alias("reasons")))
        return got.select(*keys, reply.alias("raw"))

    return judge
