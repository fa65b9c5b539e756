"""URL filters: host-suffix and path-prefix expressions of each url, joined with rules on short hash prefixes.

A url becomes a host and a path; every host suffix that begins at a label and every path prefix that ends after a
slash (and the empty one) make an expression, as far as the rules go: no rule can fit a suffix of more labels, or a prefix of more
slashes, than the rules' longest. So very long urls have no more expressions than others. Rules have one expression each: their host and their path up to its last
slash. Both sides carry the SHA-256 of the expression; the equi-join is on its first eight hex digits, then the full
digests must agree and the path must start with the whole path of the rule. Among the rules that fit, the longest
host and path together win; ties go to the longer host, then to block.

Cases: null url or no "://": empty host and path, and rules with a host can't fit. Rules with a null host are left out;
a null path of a rule is empty. Repeated rows of the input each give a row. Empty tables give no rows. Other columns of
the input come along only where asked for in `keep`, so clashing names do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

#: Rules up to this number are sent to all executors; more are joined by a shuffle.
BROADCAST_RULES = 100_000
SHORT = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_suffixes(host: Column, most: int) -> Column:
    """The host and each of its suffixes that begins after a dot, of `most` labels at most."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.greatest(F.lit(1), F.size(labels) - most + 1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def path_prefixes(path: Column, most: int) -> Column:
    """The empty prefix, and each prefix that ends with a slash, of `most` slashes at most."""
    parts = F.split(path, "/", most + 1)
    return F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda i: F.when(i == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/"))),
    )


def expressions(host: Column, path: Column, labels: int, slashes: int) -> Column:
    prefixes = path_prefixes(path, slashes)
    return F.flatten(F.transform(host_suffixes(host, labels), lambda h: F.transform(prefixes, lambda p: F.concat(h, F.lit("\n"), p))))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", keep: tuple[str, ...] = ("page_id",), default: str = "allow", broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """Columns `keep`, then host, path, rule (null if none fits) and verdict. rules: host, path, action (allow, block)."""
    host, path = host_and_path(F.col(url))
    base = pages.select(*keep, host.alias("_host"), path.alias("_path")).withColumn("_row", F.monotonically_increasing_id())
    r_path = F.coalesce(F.col("path"), F.lit(""))
    known = rules.where(F.col("host").isNotNull()).select(ascii_lower(F.col("host")).alias("r_host"), r_path.alias("r_path"), F.col("action").alias("r_action")).distinct()
    known = known.withColumn("_prefix", F.regexp_extract("r_path", r"^((?:[^/]*/)*)", 1))
    size = known.agg(F.count("*").alias("n"), F.max(F.size(F.split("r_host", r"\."))).alias("labels"), F.max(F.length("_prefix") - F.length(F.translate("_prefix", "/", ""))).alias("slashes")).first()
    known = known.withColumn("r_digest", F.sha2(F.concat("r_host", F.lit("\n"), "_prefix"), 256)).withColumn("_short", F.substring("r_digest", 1, SHORT)).drop("_prefix")
    if size.n <= broadcast_rules:
        known = F.broadcast(known)
    asked = base.withColumn("_expr", F.explode(expressions(F.col("_host"), F.col("_path"), size.labels or 1, size.slashes or 0)))
    asked = asked.withColumn("_digest", F.sha2("_expr", 256)).withColumn("_short", F.substring("_digest", 1, SHORT)).drop("_expr")
    joined = asked.join(known, "_short", "left")
    fits = (F.col("_digest") == F.col("r_digest")) & F.startswith(F.col("_path"), F.col("r_path"))
    rank = F.struct(
        (F.length("r_host") + F.length("r_path")).alias("long"),
        F.length("r_host").alias("host_long"),
        (F.col("r_action") == "block").alias("blocks"),
        F.concat("r_host", "r_path").alias("rule"),
        F.col("r_action").alias("action"),
    )
    best = F.max(F.when(fits, rank)).alias("_best")
    # partial aggregation ends each url's expressions where they arise: one row a url is shuffled
    out = joined.groupBy("_row", *keep, "_host", "_path").agg(best)
    return out.select(*keep, F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_best.rule").alias("rule"), F.coalesce(F.col("_best.action"), F.lit(default)).alias("verdict"))


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, action)")
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


OP6_SQL = r"""
WITH rules(rhost, rpath, action) AS (VALUES ('com','/','allow'),('example.com','/en/','block'),('www.example.com','/en/','allow'),('net','/es/','block'),('net','/fr/','block')),
rest AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN strpos(coalesce(url,''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS a FROM pages),
parts AS (SELECT r, page_id, translate(regexp_extract(a, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(a, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
hits AS (SELECT r, rhost || rpath AS rule, action, row_number() OVER (PARTITION BY r ORDER BY length(rhost || rpath) DESC, length(rhost) DESC, action DESC) AS k
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM parts LEFT JOIN (SELECT * FROM hits WHERE k = 1) USING (r)
"""
