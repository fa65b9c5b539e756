"""The registered queries over the driver's tables, each with the SQL that gives the same rows.

The tables have no blank, malformed or one-message rows; queries about those make some by a fixed rule, in both engines."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.functions import json as j
from talkmill.functions import text as t
from talkmill.operators import dedup, examples, generate, judge, mix, refine, render, transport
from talkmill.sources import files
from talkmill.sources.config import ConfigError, Generation, Refinement, Topic, check_probabilities, topic_rows

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chats(spark, d):
    return examples.conversations_to_examples(table(spark, d, "conversations"))


def long(c):
    return c.cast("long")


#: conversations as one row each: post, comment, number of turns
_PAIRS = "SELECT conv_id, max(CASE WHEN turn = 0 THEN text END) AS post, max(CASE WHEN turn = 1 THEN text END) AS comment, max(CASE WHEN turn = 0 THEN role END) AS role0, max(CASE WHEN turn = 1 THEN role END) AS role1, count(*) AS n FROM conversations GROUP BY conv_id"
_FOLD = r"trim(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}\p{{M}}]+', ' ', 'g'))"


# -- chat examples ---------------------------------------------------------------------------------------------------


@query("SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def chat_render(spark, d):
    return chats(spark, d).select("conv_id", render.rendered(F.col("messages")).alias("text"))


_BROKEN = """WITH broken AS (SELECT conv_id, turn, role, CASE WHEN conv_id % 7 = 0 AND turn < 2 THEN chr(160) || ' ' ELSE text END AS text FROM conversations WHERE NOT (conv_id % 11 = 0 AND turn > 0)),
p AS (SELECT conv_id, count(*) AS n, max(CASE WHEN turn = 0 THEN text END) AS a, max(CASE WHEN turn = 1 THEN text END) AS b FROM broken GROUP BY conv_id),
v AS (SELECT conv_id, n, (n >= 2 AND coalesce(regexp_matches(a, '[^\\s\\p{Z}\\x0b\\x1c-\\x1f\\x85]'), false) AND coalesce(regexp_matches(b, '[^\\s\\p{Z}\\x0b\\x1c-\\x1f\\x85]'), false)) AS ok FROM p) """.replace("\\\\", "\\")


def broken_chats(spark, d):
    """Some conversations with blank first messages, some with one message only."""
    turns = table(spark, d, "conversations").where("not (conv_id % 11 = 0 and turn > 0)")
    blank = F.when((F.col("conv_id") % 7 == 0) & (F.col("turn") < 2), F.lit("  ")).otherwise(F.col("text"))
    return examples.conversations_to_examples(turns.withColumn("text", blank))


@query(_BROKEN + "SELECT conv_id, CAST(n AS BIGINT) AS n_messages FROM v WHERE ok")
def valid_examples(spark, d):
    rows = broken_chats(spark, d).where(examples.is_valid(F.col("messages")))
    return rows.select("conv_id", long(F.size(examples.project(F.col("messages")))).alias("n_messages"))


@query(_BROKEN + "SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS malformed FROM v")
def malformed_count(spark, d):
    bad = F.count_if(~examples.is_valid(F.col("messages")))
    return broken_chats(spark, d).agg(F.count("*").alias("total"), bad.alias("malformed"))


@query("SELECT conv_id, string_agg(role || '=' || text, chr(10) ORDER BY turn) AS flat FROM conversations GROUP BY conv_id")
def project_messages(spark, d):
    wide = F.transform("messages", lambda m: F.struct(F.lit("x").alias("extra"), m["content"].alias("content"), m["role"].alias("role")))
    rows = chats(spark, d).withColumn("messages", examples.project(wide))
    return rows.select("conv_id", F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit("="), m["content"])), "\n").alias("flat"))


@query(f"SELECT conv_id, post, comment FROM ({_PAIRS})")
def post_comment_pairs(spark, d):
    m = F.col("messages")
    return chats(spark, d).select("conv_id", examples.post(m).alias("post"), examples.comment(m).alias("comment"))


# -- text ------------------------------------------------------------------------------------------------------------


def blanked(spark, d):
    blank = F.element_at(F.array(F.lit(""), F.lit("  \t"), F.lit("  "), F.lit("\x1c\x1d"), F.lit("\x85")), (F.col("doc_id") % 5 + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 7 == 0, blank).otherwise(F.concat(F.lit(" \t"), F.col("text"), F.lit("\x1f \n"))).alias("text"))


_BLANKED = "WITH b AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN '  ' || chr(9) WHEN 2 THEN chr(160) || chr(8195) WHEN 3 THEN chr(28) || chr(29) ELSE chr(133) END ELSE chr(160) || chr(9) || text || chr(31) || ' ' || chr(10) END AS text FROM documents) "


@query(_BLANKED + r"SELECT doc_id FROM b WHERE regexp_matches(text, '[^\s\p{Z}\x0b\x1c-\x1f\x{85}]')")
def blank_filter(spark, d):
    return blanked(spark, d).where(t.has_text(F.col("text"))).select("doc_id")


@query(_BLANKED + r"SELECT doc_id, md5(regexp_replace(regexp_replace(text, '^[\s\p{Z}\x0b\x1c-\x1f\x{85}]+', ''), '[\s\p{Z}\x0b\x1c-\x1f\x{85}]+$', '')) AS stripped FROM b")
def strip_text(spark, d):
    return blanked(spark, d).select("doc_id", F.md5(t.py_strip(F.col("text"))).alias("stripped"))


@query("SELECT event_id, replace(replace(chr(96)||chr(96)||chr(96)||'json'||props||chr(96)||chr(96)||chr(96), chr(96)||chr(96)||chr(96)||'json', ''), chr(96)||chr(96)||chr(96), '') AS props FROM events")
def fence_removal(spark, d):
    fenced = F.concat(F.lit("```json\n "), F.col("props"), F.lit("\n```"))
    return table(spark, d, "events").select("event_id", t.strip_fences(fenced).alias("props"))


@query("SELECT doc_id, substr(text, 1, 80) AS head FROM documents")
def head_text(spark, d):
    return table(spark, d, "documents").select("doc_id", t.head(F.col("text")).alias("head"))


@query("SELECT doc_id, 'Write ' || (doc_id % 9 + 1) || ' pairs on ' || source || ' {other} {x}' AS prompt FROM documents")
def template_fill(spark, d):
    filled = t.fill_column("Write {n} pairs on {topic} {other} {{x}}", n=F.col("doc_id") % 9 + 1, topic=F.col("source"))
    return table(spark, d, "documents").select("doc_id", filled.alias("prompt"))


@query("SELECT DISTINCT source, CASE WHEN source LIKE '%.jsonl' THEN source ELSE source || '.jsonl' END AS file FROM documents")
def name_suffix(spark, d):
    return table(spark, d, "documents").select("source").distinct().withColumn("file", t.with_suffix(F.col("source")))


@query("SELECT CAST(a AS BIGINT) AS attempt, CAST(least(2 * power(2, a), 120) AS DOUBLE) AS wait, CAST(least(2 * power(2, a + 1), 120) AS DOUBLE) AS throttled FROM range(10) r(a)")
def backoff_schedule(spark, d):
    a = F.col("id")
    return spark.range(10).select(a.alias("attempt"), t.backoff(a).alias("wait"), t.backoff(a, True).alias("throttled"))


# -- JSON lines ------------------------------------------------------------------------------------------------------


def chopped(spark, d):
    props = F.when(F.col("event_id") % 13 == 0, F.expr("substring(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    return table(spark, d, "events").select("event_id", props.alias("value"))


@query("SELECT event_id, CASE WHEN event_id % 13 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END AS value FROM events WHERE json_valid(CASE WHEN event_id % 13 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END)")
def malformed_filter(spark, d):
    return chopped(spark, d).where(j.is_json("value"))


def permuted(spark, d):
    """Objects of equal content, with names in either order."""
    a, b = F.concat(F.lit('"a": "'), F.col("user_id") % 7, F.lit('"')), F.concat(F.lit('"b": {"y": "'), F.col("event_type"), F.lit('", "x": "é"}'))
    value = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("{"), a, F.lit(", "), b, F.lit("}"))).otherwise(F.concat(F.lit("{"), b, F.lit(", "), a, F.lit("}")))
    return table(spark, d, "events").select(F.lit("f").alias("file"), F.col("event_id").alias("line_no"), value.alias("value"))


_PERMUTED = "SELECT min(event_id) AS line_no FROM events GROUP BY user_id % 7, event_type"


@query(_PERMUTED)
def canonical_json_dedup(spark, d):
    return dedup.merged(permuted(spark, d)).select("line_no")


@query(_PERMUTED)
def canonical_json_dedup_fast(spark, d):
    return dedup.merged(permuted(spark, d), exact=False).select("line_no")


@query("""SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","none":null,"word":"ñ"}' AS line FROM events""")
def json_line(spark, d):
    row = F.struct("event_id", "event_type", F.lit(None).cast("string").alias("none"), F.lit("ñ").alias("word"))
    return table(spark, d, "events").select("event_id", j.compact(row).alias("line"))


# -- merge and dedup -------------------------------------------------------------------------------------------------


@query("SELECT doc_id, source, text FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY source, doc_id) AS k FROM documents) WHERE k = 1")
def dedup_first(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "source", "text", F.sha2("text", 256).alias("key"))
    return dedup.first_of(rows, "key", ["source", "doc_id"]).select("doc_id", "source", "text")


@query("SELECT source, CAST(count(*) FILTER (WHERE k = 1) AS BIGINT) AS added FROM (SELECT source, row_number() OVER (PARTITION BY text ORDER BY source, doc_id) AS k FROM documents) GROUP BY source")
def dedup_stats_by_source(spark, d):
    docs = table(spark, d, "documents")
    first = dedup.first_of(docs.select("source", "doc_id", F.sha2("text", 256).alias("key")), "key", ["source", "doc_id"])
    return dedup.added_by_file(docs, first, "source")


@query("SELECT source, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY source")
def file_counts(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT 'documents' AS source_id, doc_id AS row_key, text FROM documents UNION ALL SELECT 'benchmark', item_id, text FROM benchmark UNION ALL SELECT 'pages', page_id, html FROM pages")
def standardize_text(spark, d):
    parts = [mix.standard(table(spark, d, n), c, n, k) for n, c, k in (("documents", "text", "doc_id"), ("benchmark", "text", "item_id"), ("pages", "html", "page_id"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT text FROM benchmark UNION ALL SELECT html FROM pages")
def union_all(spark, d):
    return mix.text_only(table(spark, d, "benchmark"), "text").unionByName(mix.text_only(table(spark, d, "pages"), "html"))


# -- batches and refinement ------------------------------------------------------------------------------------------

_SEQ = "SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS seq FROM documents"


def placed(spark, d, *more):
    rows = examples.numbered(table(spark, d, "documents").select("doc_id", F.col("source").alias("file"), *more), "file", "doc_id")
    return examples.batched(rows, 40)


@query(f"SELECT doc_id, source AS file, CAST(seq AS BIGINT) AS seq, CAST(seq // 40 AS BIGINT) AS batch_idx, CAST(seq % 40 AS BIGINT) AS i, CAST(seq // 40 * 40 AS BIGINT) AS start FROM ({_SEQ})")
def batch_assign(spark, d):
    return placed(spark, d).withColumn("i", long(F.col("i")))


def chat_batches(spark, d, size=40):
    rows = chats(spark, d).withColumn("file", F.concat(F.lit("part"), (F.col("conv_id") % 3).cast("string")))
    return examples.batched(examples.numbered(rows, "file", "conv_id"), size)


_CHAT_SEQ = f"SELECT *, 'part' || (conv_id % 3) AS file, row_number() OVER (PARTITION BY conv_id % 3 ORDER BY conv_id) - 1 AS seq FROM ({_PAIRS})"


@query(
    f"SELECT file, CAST(seq // 40 AS BIGINT) AS batch_idx, CAST(count(*) AS BIGINT) AS n, 'Check these training examples:' || chr(10) || chr(10) || string_agg('[' || (seq % 40) || '] Post: ' || coalesce(post, '') || chr(10) || '    Comment: ' || coalesce(comment, ''), chr(10) || chr(10) ORDER BY seq) AS prompt FROM ({_CHAT_SEQ}) GROUP BY file, seq // 40"
)
def batch_prompt(spark, d):
    return examples.batch_prompts(chat_batches(spark, d), ["file", "batch_idx"]).drop("start")


def label_replies(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """A judge's replies made from labels: bad quality goes; a reason is given only for toxic ones."""
    bad = rows.join(labels.where("quality = 0"), "doc_id")
    place = F.struct("i", "toxic")
    got = bad.groupBy("file", "batch_idx").agg(F.array_sort(F.collect_list(place)).alias("_r"))
    why = F.map_from_entries(F.transform(F.filter("_r", lambda r: r["toxic"] == 1), lambda r: F.struct(r["i"].cast("string"), F.lit("toxic"))))
    return got.select("file", "batch_idx", F.to_json(F.struct(F.transform("_r", lambda r: r["i"]).alias("remove"), why.alias("reasons"))).alias("raw"))


def decided(spark, d):
    rows = placed(spark, d)
    batches = rows.groupBy("file", "batch_idx").agg(F.count("*").alias("n"))
    return rows, refine.judged(batches, label_replies(rows, table(spark, d, "labels")), ["file", "batch_idx"])


_JUDGED = f"WITH s AS ({_SEQ}), x AS (SELECT s.doc_id, s.source AS file, seq, coalesce(l.quality = 0, false) AS removed, CASE WHEN l.quality = 0 THEN CASE WHEN l.toxic = 1 THEN 'toxic' ELSE 'no reason given' END END AS reason FROM s LEFT JOIN labels l ON s.doc_id = l.doc_id) "


@query(_JUDGED + "SELECT file, CAST(seq // 40 AS BIGINT) AS batch_idx, CAST(count(*) FILTER (WHERE removed) AS BIGINT) AS n_remove, bool_or(removed) AS ok FROM x GROUP BY file, seq // 40")
def judge_verdicts(spark, d):
    return decided(spark, d)[1].select("file", "batch_idx", long(F.size("remove")).alias("n_remove"), "ok")


def refined(spark, d):
    rows, verdict = decided(spark, d)
    return refine.split(rows, verdict, ["file", "batch_idx"])


@query(_JUDGED + "SELECT file, doc_id, CAST(seq AS BIGINT) AS global_idx FROM x WHERE NOT removed")
def refine_kept(spark, d):
    return refine.kept(refined(spark, d)).select("file", "doc_id", "global_idx")


@query(_JUDGED + "SELECT file, doc_id, CAST(seq AS BIGINT) AS global_idx, reason FROM x WHERE removed")
def refine_removed(spark, d):
    return refined(spark, d).where("removed").select("file", "doc_id", "global_idx", "reason")


@query(_JUDGED + "SELECT file, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE NOT removed) AS BIGINT) AS kept, CAST(count(*) FILTER (WHERE removed) AS BIGINT) AS removed, CAST(100 * count(*) FILTER (WHERE NOT removed) // count(*) AS BIGINT) AS percent FROM x GROUP BY file")
def retention(spark, d):
    return refine.retention(refined(spark, d))


@query("SELECT DISTINCT d.source AS file FROM documents d WHERE NOT EXISTS (SELECT 1 FROM documents e JOIN labels l ON e.doc_id = l.doc_id AND l.toxic = 1 AND l.quality = 0 WHERE e.source = d.source)")
def pending_files(spark, d):
    docs = table(spark, d, "documents").withColumnRenamed("source", "file")
    done = docs.join(table(spark, d, "labels").where("toxic = 1 and quality = 0"), "doc_id", "left_semi")
    return refine.pending(docs, done)


# -- rules of the offline judge --------------------------------------------------------------------------------------

_A, _B = _FOLD.format("post"), _FOLD.format("comment")


@query(f"SELECT conv_id, row_number() OVER (PARTITION BY file, seq // 40, {_A}, {_B} ORDER BY seq) > 1 AS repeat FROM ({_CHAT_SEQ})")
def repeat_in_batch(spark, d):
    return judge.repeats_in_batch(chat_batches(spark, d), ["file", "batch_idx"]).select("conv_id", "repeat")


@query(
    f"SELECT conv_id, CAST(len(list_intersect(a, b)) AS DOUBLE) / len(list_distinct(list_concat(a, b))) AS overlap FROM (SELECT conv_id, list_distinct(string_split({_A}, ' ')) AS a, list_distinct(string_split({_B}, ' ')) AS b FROM ({_PAIRS}))"
)
def word_overlap(spark, d):
    return chats(spark, d).select("conv_id", judge.overlap(F.col("messages")).alias("overlap"))


@query(f"SELECT conv_id, coalesce(regexp_matches(post, '(?i)\\[(post text|comment|natural banglish comment)\\]') OR regexp_matches(comment, '(?i)\\[(post text|comment|natural banglish comment)\\]'), false) AS found FROM (SELECT conv_id, CASE WHEN conv_id % 5 = 0 THEN '[Post text] ' || post ELSE post END AS post, comment FROM ({_PAIRS}))")
def placeholder_rule(spark, d):
    turns = table(spark, d, "conversations")
    marked = F.when((F.col("conv_id") % 5 == 0) & (F.col("turn") == 0), F.concat(F.lit("[Post text] "), F.col("text"))).otherwise(F.col("text"))
    return examples.conversations_to_examples(turns.withColumn("text", marked)).select("conv_id", judge.placeholder(F.col("messages")).alias("found"))


@query("SELECT doc_id, CAST(regexp_extract_all(text, '[A-Za-z]')[1] IS NOT NULL AS INT) AS latin, CASE WHEN regexp_matches(text, '\\p{Bengali}') AND regexp_matches(text, '[A-Za-z]') THEN 'mixed' WHEN regexp_matches(text, '\\p{Bengali}') THEN 'bengali' WHEN regexp_matches(text, '[A-Za-z]') THEN 'roman' ELSE 'other' END AS script FROM documents")
def script_of(spark, d):
    return table(spark, d, "documents").select("doc_id", F.col("text").rlike("[A-Za-z]").cast("int").alias("latin"), judge.script(F.col("text")).alias("script"))


@query("WITH x AS (SELECT source, CASE WHEN doc_id % 3 = 0 THEN 'bengali' WHEN doc_id % 3 = 1 THEN 'mixed' ELSE 'roman' END AS script FROM documents WHERE regexp_matches(text, '[A-Za-z]')) SELECT source, script, CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY source) AS share FROM x GROUP BY source, script")
def script_mix(spark, d):
    docs = table(spark, d, "documents").where(F.col("text").rlike("[A-Za-z]"))
    text = F.when(F.col("doc_id") % 3 == 0, F.lit("কথা")).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("কথা "), F.col("text"))).otherwise(F.regexp_replace("text", "[^A-Za-z]", ""))
    return judge.script_mix(docs.withColumn("text", text), ["source"], "text")


@query("SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '[.!?।\\n]+'), lambda s: regexp_matches(s, '\\S'))) AS BIGINT) AS n FROM documents")
def sentence_count(spark, d):
    return table(spark, d, "documents").select("doc_id", long(judge.sentences(F.col("text"))).alias("n"))


_WORDS = _FOLD.format("text")


@query(f"WITH v AS (SELECT DISTINCT unnest(string_split({_WORDS}, ' ')) AS word FROM conversations), w AS (SELECT DISTINCT item_id, unnest(string_split({_WORDS}, ' ')) AS word FROM benchmark) SELECT item_id, CAST(count(*) FILTER (WHERE v.word IS NULL) AS DOUBLE) / count(*) AS rate FROM w LEFT JOIN v ON w.word = v.word WHERE w.word <> '' GROUP BY item_id")
def unknown_words(spark, d):
    vocabulary = table(spark, d, "conversations").select(F.explode(F.split(judge.folded(F.col("text")), " ")).alias("word"))
    return judge.unknown_rate(table(spark, d, "benchmark"), vocabulary, "item_id", "text")


# -- mixing, splitting -----------------------------------------------------------------------------------------------

WEIGHTS = {"en": 0.4, "fr": 0.25, "de": 0.25, "es": 0.1}


def by_lang(spark, d):
    return table(spark, d, "documents").select(F.col("lang").alias("source_id"), F.col("doc_id").alias("row_key"), "text")


@query("SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS k FROM documents) WHERE k <= 60")
def source_slice(spark, d):
    from talkmill.sources.hub import Registry, split_of

    docs = table(spark, d, "documents").select("doc_id", "lang")
    registry = Registry("none")
    registry.register("documents", lambda s, split, config: docs.where(F.col("lang") == config))
    parts = [registry.pull(spark, "documents", f"train[:{split_of('train[:60]')[1]}]", lang, "doc_id") for lang in WEIGHTS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_U = "(('0x' || substr(md5('42|' || lang || '|' || doc_id), 1, 13))::UBIGINT::DOUBLE / 4503599627370496)"


@query(
    f"SELECT source_id, row_key, CAST(row_number() OVER (ORDER BY round(arrival, 6), source_id, row_key) AS BIGINT) AS pos FROM (SELECT lang AS source_id, doc_id AS row_key, sum(-ln(1e0 - {_U}) / CASE lang WHEN 'en' THEN 0.4::DOUBLE WHEN 'fr' THEN 0.25::DOUBLE WHEN 'de' THEN 0.25::DOUBLE ELSE 0.1::DOUBLE END) OVER (PARTITION BY lang ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS arrival FROM documents)"
)
def interleave_weighted(spark, d):
    rows = mix.interleaved(by_lang(spark, d).drop("text"), WEIGHTS).withColumn("a", F.round("arrival", 6))
    edges = rows.agg(F.percentile_approx("a", [i / 32 for i in range(1, 32)], 10_000)).first()[0] or []
    bucket = F.size(F.filter(F.array(*[F.lit(x) for x in edges]) if edges else F.array().cast("array<double>"), lambda e: e < F.col("a")))
    return mix.numbered(rows, [F.col("a"), F.col("source_id"), F.col("row_key")], 32, bucket).select("source_id", "row_key", "pos")


@query("SELECT lang AS source_id, doc_id AS row_key, (row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 0.5::DOUBLE) / CASE lang WHEN 'en' THEN 0.4::DOUBLE WHEN 'fr' THEN 0.25::DOUBLE WHEN 'de' THEN 0.25::DOUBLE ELSE 0.1::DOUBLE END AS arrival FROM documents")
def interleave_stride(spark, d):
    return mix.strided(by_lang(spark, d), WEIGHTS).select("source_id", "row_key", "arrival")


@query("SELECT doc_id, CAST(pos AS BIGINT) AS pos FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) AS pos FROM documents) WHERE pos <= 300")
def shuffle_take(spark, d):
    return mix.take(mix.shuffled(table(spark, d, "documents").select("doc_id"), "doc_id"), 300)


@query("SELECT source_id, row_key FROM (SELECT lang AS source_id, doc_id AS row_key, row_number() OVER (ORDER BY md5('42|' || lang || '|' || doc_id), lang || '|' || doc_id) AS pos FROM documents) WHERE pos <= 300")
def mixed_reference(spark, d):
    return mix.mixed(by_lang(spark, d), WEIGHTS, 300).select("source_id", "row_key")


@query("SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) <= ceil(0.1::DOUBLE * (SELECT count(*) FROM documents)) THEN 'eval' ELSE 'train' END AS split FROM documents")
def train_eval_split(spark, d):
    return mix.exact_split(table(spark, d, "documents").select("doc_id"), "doc_id", 0.1)


@query("WITH q AS (SELECT lang, 10 * row_number() OVER (ORDER BY lang) AS n FROM (SELECT DISTINCT lang FROM documents)) SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS k FROM documents) JOIN q USING (lang) WHERE k <= n")
def topic_quota(spark, d):
    topics = topic_rows(spark, [Topic(x, 10 * i) for i, x in enumerate(sorted(WEIGHTS), 1)]).withColumnRenamed("topic", "lang")
    return generate.within_quota(table(spark, d, "documents").select("doc_id", "lang"), topics, "lang", "doc_id")


@query("SELECT lang, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM documents) AS p, true AS sums_to_one FROM documents GROUP BY lang")
def probability_check(spark, d):
    docs = table(spark, d, "documents")
    shares = docs.groupBy("lang").agg(F.count("*").alias("n")).withColumn("p", F.col("n") / F.lit(docs.count())).select("lang", "p")
    try:
        check_probabilities([r.p for r in shares.collect()])  # a row a language
    except ConfigError:
        return shares.withColumn("sums_to_one", F.lit(False))
    return shares.withColumn("sums_to_one", F.lit(True))


# -- reports ---------------------------------------------------------------------------------------------------------


@query("SELECT CAST(doc_id AS VARCHAR) AS label, CAST(length(text) AS INT) AS chars, CAST(strlen(text) AS INT) AS tokens, CAST(strlen(text) AS DOUBLE) / length(text) AS ratio, CASE WHEN strlen(text) / length(text) < 1.5 THEN 'Excellent' WHEN strlen(text) / length(text) < 2.5 THEN 'Acceptable' ELSE 'Inefficient' END AS assessment FROM documents")
def token_report(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    return render.report(docs, "id", "text", render.utf8_bytes(F.col("text")))


@query("SELECT doc_id, format('{:<25} {:>6} {:>7} {:>7.2f} {}', source, length(text), strlen(text), strlen(text)::DOUBLE / length(text), CASE WHEN strlen(text) / length(text) < 1.5 THEN 'Excellent' WHEN strlen(text) / length(text) < 2.5 THEN 'Acceptable' ELSE 'Inefficient' END) AS line FROM documents")
def report_lines(spark, d):
    chars, tokens = F.length("text"), F.octet_length("text")
    ratio = t.efficiency(tokens, chars)
    return table(spark, d, "documents").select("doc_id", t.report_line(F.col("source"), chars, tokens, ratio, t.assessment(ratio)).alias("line"))


@query("SELECT doc_id, CAST(strlen(text) AS BIGINT) AS tokens FROM documents WHERE strlen(text) > 2048")
def too_long(spark, d):
    return render.too_long(table(spark, d, "documents"), render.utf8_bytes(F.col("text")), 2048).select("doc_id", long(F.col("tokens")).alias("tokens"))


@query(
    "SELECT * FROM (VALUES " + ", ".join(f"('{label}', {len(text)}, {len(text.encode())})" for label, text in render.TEST_STRINGS) + ") v(label, chars, tokens)"
)
def test_strings(spark, d):
    rows = spark.createDataFrame(render.TEST_STRINGS, "label string, text string")
    return render.report(rows, "label", "text", render.utf8_bytes(F.col("text"))).select("label", "chars", "tokens")


# -- model calls -----------------------------------------------------------------------------------------------------


@query("""SELECT conv_id, '{"model":"m","messages":[{"role":"user","content":"' || 'conversation ' || conv_id || '"}],"temperature":0.1,"max_tokens":1000,"reasoning":{"effort":"none"}}' AS request FROM (SELECT DISTINCT conv_id FROM conversations)""")
def request_json(spark, d):
    message = F.struct(F.lit("user").alias("role"), F.concat(F.lit("conversation "), F.col("conv_id").cast("string")).alias("content"))
    rows = table(spark, d, "conversations").select("conv_id").distinct()
    return rows.select("conv_id", transport.request_column(Refinement(model="m"), F.array(message)).alias("request"))


class EchoTransport:
    """Answers without a network: a list of examples for a prompt that names a number and a topic."""

    def send(self, request, timeout):
        n, topic = request["messages"][-1]["content"].split("|")
        found = [{"messages": [{"role": "user", "content": f"{topic} {k}"}, {"role": "assistant", "content": f"on {topic}"}]} for k in range(int(n) + 1)]
        return 200, json.dumps({"choices": [{"message": {"content": "```json" + json.dumps(found) + "```"}}]})


@query("WITH q AS (SELECT source AS topic, CAST(count(*) AS INT) AS count FROM documents GROUP BY source) SELECT topic, CAST(k AS BIGINT) AS seq, CAST(k // 21 + 1 AS BIGINT) AS batch_no FROM q, range(100000) r(k) WHERE k < count")
def generate_topics(spark, d):
    topics = table(spark, d, "documents").groupBy("source").agg(F.count("*").cast("int").alias("count"))
    topics = topics.select(F.pmod(F.xxhash64("source"), F.lit(1_000_000_007)).cast("int").alias("topic_idx"), F.col("source").alias("topic"), "count")
    cfg = Generation(model="echo", prompt="{n}|{topic}", max_workers=8)
    out = generate.generate(topics, cfg, EchoTransport(), max_rounds=100_000, sleep=_no_sleep)
    return out.select("topic", long(F.col("seq")).alias("seq"), long(F.col("batch_no")).alias("batch_no"))


def _no_sleep(seconds: float) -> None:
    return None


@query(f"SELECT conv_id, row_number() OVER (PARTITION BY file, seq // 40, {_A}, {_B} ORDER BY seq) > 1 AS removed FROM ({_CHAT_SEQ})")
def refine_offline(spark, d):
    rows = chat_batches(spark, d)
    return refine.refine(rows.drop("batch_idx", "i", "start"), judge.offline_judge(rows)).select("conv_id", "removed")


# -- files -----------------------------------------------------------------------------------------------------------


def shared(spark, name: str) -> str:
    """A new folder for a query's files, shared with the executors."""
    import uuid

    return f"{files.shared_root(spark)}/talkmill/{name}-{uuid.uuid4().hex}"


@query("SELECT conv_id, CAST(count(*) AS BIGINT) AS n FROM conversations WHERE conv_id % 10 <> 3 GROUP BY conv_id")
def jsonl_scan(spark, d):
    """Examples are written as JSON lines, a tenth of them cut short, and scanned again."""
    from talkmill.sources import jsonl

    line = j.compact(F.struct("conv_id", "messages"))
    cut = F.when(F.col("conv_id") % 10 == 3, F.substring(line, 1, 20)).otherwise(line)
    path = shared(spark, "scan")
    jsonl.write_jsonl(chats(spark, d).select(cut.alias("line")), path, value="line")
    rows, _ = jsonl.scan_jsonl(spark, [path])
    return examples.read_examples(rows).select(F.get_json_object("value", "$.conv_id").cast("long").alias("conv_id"), long(F.size("messages")).alias("n"))


@query("SELECT conv_id FROM conversations WHERE turn = 0")
def streaming_refine_parity(spark, d):
    """Conversations written as JSON lines, refined by the stream in one run, and read again with what was removed."""
    from talkmill.sources import jsonl
    from talkmill.streaming import incremental

    root = shared(spark, "stream")
    rows = chats(spark, d).select(j.compact(F.struct("conv_id", "messages")).alias("line"))
    jsonl.write_jsonl(rows, f"{root}/in", value="line")
    incremental.refine_new_files(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", lambda b: b.select("file", "batch_idx", F.lit('{"remove":[0]}').alias("raw")))
    kept = spark.read.parquet(f"{root}/out/refined").select("messages")
    gone = spark.read.parquet(f"{root}/out/removed").select("example.messages")
    key = F.struct(F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))))
    ids = chats(spark, d)
    both = kept.unionByName(gone).withColumn("k", F.sha2(F.to_json(key), 256)).dropDuplicates(["k"])
    return ids.withColumn("k", F.sha2(F.to_json(key), 256)).join(both.select("k"), "k", "left_semi").select("conv_id")


def written_chats(spark, d, name: str) -> str:
    """A folder of two JSON-lines files, of even and of odd conversations; a blank line follows each tenth."""
    root = shared(spark, name)
    rows = chats(spark, d).withColumn("line", F.concat(j.compact(F.struct("conv_id", "messages")), F.when(F.col("conv_id") % 10 == 0, F.lit("\n")).otherwise(F.lit(""))))
    from talkmill.sources import jsonl

    for k in (0, 1):
        jsonl.write_jsonl(rows.where(F.col("conv_id") % 2 == k), f"{root}/part{k}.jsonl", ["conv_id"], "line")
    return root


def conv_id(value: str = "value"):
    return F.get_json_object(value, "$.conv_id").cast("long")


@query("WITH x AS (SELECT DISTINCT conv_id FROM conversations) SELECT conv_id, 'part' || (conv_id % 2) || '.jsonl' AS file, CAST(row_number() OVER (PARTITION BY conv_id % 2 ORDER BY conv_id) + count(*) FILTER (WHERE conv_id % 10 = 0) OVER (PARTITION BY conv_id % 2 ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS line_no FROM x")
def folder_scan_lines(spark, d):
    """All files of a folder: physical line numbers, blank lines counted but skipped."""
    from talkmill.sources import jsonl

    rows, _ = jsonl.scan_folder(spark, written_chats(spark, d, "folder"))
    return rows.select(conv_id().alias("conv_id"), "file", "line_no")


@query("SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id % 2 ORDER BY conv_id) - 1 AS BIGINT) AS seq FROM (SELECT DISTINCT conv_id FROM conversations) WHERE conv_id % 2 = 1")
def named_scan_fail_fast(spark, d):
    """One file by name, where a malformed line would raise, numbered by parsed rows; another file of the folder is one's own."""
    from talkmill.sources import jsonl

    root = written_chats(spark, d, "named")
    rows, _ = jsonl.scan_folder(spark, root, f"{root}/part0.jsonl", "fail")
    assert jsonl.scan_named(spark, f"{root}/none.jsonl") is None and jsonl.scan_folder(spark, f"{root}/none") is None
    return jsonl.with_seq(rows).select(conv_id().alias("conv_id"), long(F.col("seq")).alias("seq"))


@query(_JUDGED + "SELECT file, CAST(seq AS BIGINT) AS global_idx, doc_id, reason, source AS more FROM x JOIN documents USING (doc_id) WHERE removed")
def removed_records(spark, d):
    """Removed examples as they are written: whole, with keys that the schema of examples does not know."""
    rows = placed(spark, d, "source", F.array(F.struct(F.lit("user").alias("role"), F.lit("x").alias("content"))).alias("messages"))
    rows = rows.withColumn("value", j.compact(F.struct("doc_id", F.col("source").alias("more"), "messages")))
    verdict = decided(spark, d)[1]
    lines = refine.removed_lines(refine.split(rows, verdict, ["file", "batch_idx"]))
    at = lambda path, kind: F.try_variant_get(F.parse_json("line"), path, kind)
    return lines.select("file", at("$.global_idx", "bigint").alias("global_idx"), at("$.example.doc_id", "bigint").alias("doc_id"), at("$.reason", "string").alias("reason"), at("$.example.more", "string").alias("more"))


@query("SELECT file, CAST(seq AS BIGINT) AS global_idx FROM (" + _SEQ.replace("doc_id, source,", "doc_id, source AS file,") + ") x JOIN labels l USING (doc_id) WHERE l.quality = 0")
def removed_log(spark, d):
    """A line of the log for each removed row."""
    rows = placed(spark, d).withColumn("messages", F.array(F.struct(F.lit("user").alias("role"), F.lit("x").alias("content"))))
    log = refine.removed_report(refine.split(rows, decided(spark, d)[1], ["file", "batch_idx"]))
    return log.select("file", F.regexp_extract("line", r"^\[(\d+)\]", 1).cast("long").alias("global_idx"))


@query("SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 77")
def stored_slice(spark, d):
    """train[:77] of a dataset in storage order: rows pushed in order of id, and pulled without a key."""
    from talkmill.sources.hub import Registry

    registry = Registry(shared(spark, "hub"))
    registry.push(table(spark, d, "documents").select("doc_id", "text").orderBy("doc_id"), "docs")
    return registry.pull(spark, "docs", "train[:77]")


@query("SELECT lang AS topic, CAST(row_number() OVER (ORDER BY lang) AS INT) AS topic_idx, CAST(5 * row_number() OVER (ORDER BY lang) AS INT) AS count FROM (SELECT DISTINCT lang FROM documents)")
def topic_index(spark, d):
    langs = [r[0] for r in table(spark, d, "documents").select("lang").distinct().orderBy("lang").collect()]
    return topic_rows(spark, [Topic(x, 5 * i) for i, x in enumerate(langs, 1)])


@query(f"SELECT conv_id, CASE WHEN conv_id % 4 = 0 THEN true ELSE false END AS found FROM ({_PAIRS})")
def assistant_rule(spark, d):
    turns = table(spark, d, "conversations")
    spoken = F.when((F.col("conv_id") % 4 == 0) & (F.col("turn") == 1), F.concat(F.lit("As an AI language model, "), F.col("text"))).otherwise(F.col("text"))
    return examples.conversations_to_examples(turns.withColumn("text", spoken)).select("conv_id", judge.sounds_assistant(F.col("messages")).alias("found"))


def answered(spark, d):
    """Conversations whose comment is one of five, and whose post is one of four or their own."""
    turns = table(spark, d, "conversations").where("turn < 2")
    text = F.when(F.col("turn") == 1, F.concat(F.lit("Answer, no. "), (F.col("conv_id") % 5).cast("string"))).when(F.col("conv_id") % 3 == 0, F.concat(F.lit("Post "), (F.col("conv_id") % 4).cast("string"))).otherwise(F.concat(F.lit("Own "), F.col("conv_id").cast("string")))
    return examples.conversations_to_examples(turns.withColumn("text", text))


_ANSWERED = "SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN 'post ' || (conv_id % 4) ELSE 'own ' || conv_id END AS post, 'answer no ' || (conv_id % 5) AS comment FROM (SELECT conv_id FROM conversations WHERE turn < 2 GROUP BY conv_id HAVING count(*) = 2)"


@query(f"SELECT comment, CAST(count(DISTINCT post) AS BIGINT) AS posts FROM ({_ANSWERED}) GROUP BY comment HAVING count(DISTINCT post) >= 3")
def generic_comments(spark, d):
    return judge.generic_comments(answered(spark, d), 3)


@query(f"SELECT md5(post || chr(10) || comment) AS pair, CAST(count(*) AS BIGINT) AS n FROM ({_ANSWERED}) GROUP BY 1 HAVING count(*) >= 2")
def boilerplate_pairs(spark, d):
    return judge.boilerplate(answered(spark, d), 2)


@query("SELECT role, CAST(count(*) AS BIGINT) AS n FROM conversations GROUP BY role")
def role_types(spark, d):
    """Messages read with the typed schema of examples."""
    from talkmill.schemas import EXAMPLE

    line = j.compact(F.struct("messages"))
    typed = chats(spark, d).select(F.from_json(line, EXAMPLE)["messages"].alias("messages"))
    return typed.select(F.explode("messages").alias("m")).groupBy(F.col("m.role").alias("role")).agg(F.count("*").alias("n"))


_ONE = [{"path": "x", "probability": 1}]
#: Settings that a check rejects, and some that it lets through: name, section, what is given, whether it passes.
_SETTINGS = [
    ("temperature", "generation", {"temperature": 2.5}, False), ("temperature at its most", "refinement", {"temperature": 2}, True), ("max_tokens", "generation", {"max_tokens": 0}, False),
    ("batch_size", "refinement", {"batch_size": -1}, False), ("batch_timeout", "generation", {"batch_timeout": 0}, False), ("max_retries", "refinement", {"max_retries": 0}, False),
    ("max_workers", "generation", {"max_workers": 0}, False), ("max_workers unset", "refinement", {"max_workers": None}, True), ("prompt without a place", "generation", {"prompt": "x"}, False),
    ("max_seq_length", "model", {"max_seq_length": 0}, False), ("no sources", "cpt_training", {}, False), ("sum below", "cpt_training", {"datasets": [{"path": "x", "probability": 0.98}]}, False),
    ("sum near", "cpt_training", {"datasets": [{"path": "x", "probability": 1.005}]}, True), ("alpha", "cpt_training", {"datasets": _ONE, "lora_alpha": 8}, False), ("epochs", "cpt_training", {"datasets": _ONE, "epochs": 0}, False),
    ("negative share", "cpt_training", {"datasets": [*_ONE, {"path": "y", "probability": -0.001}]}, False), ("eval_split 0", "sft_training", {"eval_split": 0}, False), ("eval_split 1", "sft_training", {"eval_split": 1}, False),
    ("eval_split unset", "sft_training", {"eval_split": None}, True), ("learning_rate", "sft_training", {"learning_rate": 0}, False),
]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{name}', {str(ok).lower()})" for name, _, _, ok in _SETTINGS) + ") v(setting, accepted)")
def configuration_checks(spark, d):
    from talkmill.sources.config import Config

    def accepted(section: str, given: dict) -> bool:
        try:
            Config({section: given})[section]
        except ConfigError:
            return False
        return True

    return spark.createDataFrame([(name, accepted(section, given)) for name, section, given, _ in _SETTINGS], "setting string, accepted boolean")


@query("SELECT conv_id, CASE WHEN conv_id % 2 = 0 THEN 'a.jsonl' ELSE 'b.jsonl' END AS file FROM (SELECT DISTINCT conv_id FROM conversations)")
def merged_file(spark, d):
    """Two files, the second of which repeats the first with names in another order, merged, written and read again."""
    from talkmill.sources import jsonl

    root = shared(spark, "merge")
    rows = chats(spark, d)
    jsonl.write_jsonl(rows.where("conv_id % 2 = 0").select("conv_id", j.compact(F.struct("conv_id", "messages")).alias("line")), f"{root}/in/a.jsonl", ["conv_id"], "line")
    jsonl.write_jsonl(rows.select("conv_id", j.compact(F.struct("messages", "conv_id")).alias("line")), f"{root}/in/b.jsonl", ["conv_id"], "line")
    found, _ = jsonl.scan_folder(spark, f"{root}/in")
    first = dedup.merged(found.select("file", "line_no", "value"))
    jsonl.write_jsonl(first, f"{root}/merged.jsonl", ["file", "line_no"], "value")
    kept, _ = jsonl.scan_named(spark, f"{root}/merged.jsonl")
    return kept.select(conv_id().alias("conv_id")).join(first.select(conv_id().alias("conv_id"), "file"), "conv_id")


@query("SELECT text AS content, CAST(count(*) AS BIGINT) AS n FROM conversations GROUP BY text")
def pushed_and_pulled(spark, d):
    """Examples read from JSON with their schema, pushed as a named dataset and pulled again."""
    from talkmill.schemas import EXAMPLE
    from talkmill.sources import jsonl
    from talkmill.sources.hub import Registry

    root = shared(spark, "push")
    jsonl.write_jsonl(chats(spark, d).select("messages"), f"{root}/merged.jsonl")
    registry = Registry(f"{root}/hub")
    registry.push(spark.read.schema(EXAMPLE).json(f"{root}/merged.jsonl"), "chats")
    got = registry.pull(spark, "chats")
    return got.select(F.explode("messages").alias("m")).groupBy(F.col("m.content").alias("content")).agg(F.count("*").alias("n"))


@query("SELECT * FROM (VALUES ('run', 'run.jsonl'), ('run.jsonl', 'run.jsonl'), ('', 'set_20240229_130405.jsonl')) v(given, name)")
def run_names(spark, d):
    from datetime import datetime

    clock = datetime(2024, 2, 29, 13, 4, 5)
    return spark.createDataFrame([(x, t.run_name(x or None, clock, "set")) for x in ("run", "run.jsonl", "")], "given string, name string")
