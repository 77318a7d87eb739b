"""URL filters (7): host-suffix and path-prefix expressions, hash-prefix join, full-digest check.

A URL is expanded into the host suffixes of as many labels, with the path prefixes of as many characters, as
some rule has: a url's expressions are as many as the rules' shapes, however long it is. The
expressions meet the rules on the first 32 bits of their SHA-256 (an equi-join, so Spark may broadcast
the rules only under its own size threshold); the full digest then confirms, and of the rules that fit
the longest decides (then the longer host, then the rule's text).

Defined results: hosts of rules are lower-cased like those of urls (A-Z); a rule with a null part fits nothing; a null url, or one without ``://``, has host and path '' and no rule; repeated rows
give repeated rows; an empty table gives no rows; with no rules every verdict is the default. Only
page_id and url are read, so other columns can have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

#: (host, path, verdict): the rules of the registered query.
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))
DEFAULT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return shared.literal_table(spark, rules, ("host", "path", "verdict"))


def parts(url) -> tuple:
    """Host (A-Z lower-cased) and path of a url column; both '' without ``://``."""
    host = F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER), F.coalesce(path, F.lit(""))


def _digest(host, path):
    return F.sha2(F.concat(host, F.lit("\x00"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule, verdict: one row for each row of ``pages``."""
    host, path = parts(F.col("url"))
    alike = pages.groupBy("page_id", "url").agg(F.count("*").alias("n")).withColumn("host", host).withColumn("path", path)
    rules = rules.filter("host IS NOT NULL AND path IS NOT NULL").withColumn("host", F.translate("host", UPPER, LOWER))
    labels = lambda c: F.length(c) - F.length(F.replace(F.col(c), F.lit("."))) + 1
    shapes = [tuple(r) for r in rules.select(labels("host").alias("labels"), F.length("path").alias("length")).distinct().orderBy("labels", "length").collect()]
    one_of = lambda n, m: F.when((labels("host") >= n) & (F.length("path") >= m), _digest(F.substring_index("host", ".", -n), F.substring("path", 1, m)))
    both = F.array_compact(F.array(*(one_of(n, m) for n, m in shapes))) if shapes else F.array().cast("array<string>")
    wide = alike.select("page_id", "url", "host", "path", "n", F.explode_outer(both).alias("digest")).withColumn("short", F.substring("digest", 1, 8))
    known = rules.select(
        F.col("host").alias("rh"), F.col("path").alias("rp"), F.col("verdict").alias("rv"), _digest(F.col("host"), F.col("path")).alias("rd")
    ).withColumn("rs", F.substring("rd", 1, 8))
    met = wide.join(known, (F.col("short") == F.col("rs")) & (F.col("digest") == F.col("rd")), "left")
    best = F.when(F.col("rd").isNotNull(), F.struct((F.length("rh") + F.length("rp")).alias("a"), F.length("rh").alias("b"), F.concat("rh", "rp").alias("rule"), F.col("rv").alias("verdict")))
    one = met.groupBy("page_id", "url").agg(F.first("host").alias("host"), F.first("path").alias("path"), F.first("n").alias("n"), F.max(best).alias("best"))
    return one.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"), F.explode(F.array_repeat(F.lit(1), F.col("n").cast("int"))).alias("_")
    ).drop("_")


def op7_url_filters(spark, sf_dir: str) -> DataFrame:
    return judge(shared.table(spark, sf_dir, "pages").select("page_id", "url"), rule_table(spark))


SQL = r"""
WITH p AS (SELECT row_number() OVER () AS r, page_id,
    coalesce(translate(regexp_extract(url, '^(?s).*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^(?s).*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(h, q, v) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'),
    ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
hit AS (SELECT r, h || q AS rule, v, row_number() OVER (PARTITION BY r ORDER BY length(h) + length(q) DESC, length(h) DESC) AS k
    FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN hit ON p.r = hit.r AND k = 1
"""
