"""URL filters by hashed host-suffix / path-prefix expressions (DataFrame functions only).

A rule is (action, host, path). Its key is the host joined with the path's directory part (up to the last slash);
a URL is expanded into the same kind of expressions: every host suffix that starts at a label, joined with the
empty string and with every directory prefix of its path, as deep as the deepest rule goes. Both sides meet on the first 32 bits of the
expression's SHA-256; the full digest and the rest of the rule's path are confirmed afterwards, and the longest
rule wins (host and path together; ties: the longer host, then block before allow).

Defined results: a null URL, or one without ``://``, has an empty host and path and fits no rule; an empty table
gives an empty result; repeated rows are judged alike; other columns are ignored; a rule without a host fits
nothing. URLs that fit no rule get ``default``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_UPPER, _LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The rules of the registered query (action, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/")]


def host_and_path(url) -> tuple:
    """Host (A-Z lower-cased) and path of a URL column; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)\z", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWERED)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def _digest(expression):
    return F.sha2(expression, 256)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules with their digests, one row for each distinct rule."""
    df = spark.createDataFrame([(a, h.lower(), p) for a, h, p in rules if h],
                               "action string, rule_host string, rule_path string")
    return hashed_rules(df)


def hashed_rules(rules: DataFrame) -> DataFrame:
    folder = F.regexp_extract("rule_path", r"(?s)^(.*/)", 1)
    return (rules.dropDuplicates().withColumn("digest", _digest(F.concat("rule_host", F.lit("\n"), folder)))
            .withColumn("short", F.substring("digest", 1, 8)))


def _slashes(path: str):
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _labels(host: str):
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def expand(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path) -> one row for each host suffix and directory prefix that a rule can have, with digest and short
    hash. No rule has more labels or directories than the deepest one, so longer expressions meet nothing: a URL of any
    length gives a bounded number of them."""
    most = lambda count, column: F.greatest(F.lit(1), F.coalesce(
        rules.select(F.max(count(column))).scalar(), F.lit(1)))
    labels = F.sequence(F.lit(1), F.least(_labels("host"), most(_labels, "rule_host")))
    slashes = F.sequence(F.lit(0), F.least(_slashes("path"), most(_slashes, "rule_path")))
    suffix, folder = F.expr("substring_index(host, '.', -n_labels)"), F.expr("substring_index(path, '/', n_slashes)")
    return (urls.filter(F.col("host") != "")
            .withColumn("n_labels", F.explode(labels)).withColumn("n_slashes", F.explode(slashes))
            .withColumn("suffix", suffix)
            .withColumn("folder", F.when(F.col("n_slashes") > 0, F.concat(folder, F.lit("/"))).otherwise(F.lit("")))
            .withColumn("digest", _digest(F.concat("suffix", F.lit("\n"), "folder")))
            .withColumn("short", F.substring("digest", 1, 8)))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """pages (with page_id, url) -> page_id, host, path, rule, verdict.

    Work is done once for each distinct (host, path); the pages then get it by an equi-join whose hot keys the
    adaptive planner splits.
    """
    host, path = host_and_path(F.col("url"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = pages.select("host", "path").distinct()
    found = (expand(urls, rules).alias("u").join(rules.alias("r"), F.col("u.short") == F.col("r.short"))
             .filter((F.col("u.digest") == F.col("r.digest")) & F.expr("startswith(u.path, r.rule_path)"))
             .select("u.host", "u.path", "r.action", "r.rule_host", "r.rule_path"))
    best = found.groupBy("host", "path").agg(F.max(F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("size"), F.length("rule_host").alias("host_size"),
        (F.col("action") == "block").alias("blocks"), "action", "rule_host", "rule_path")).alias("best"))
    return (pages.join(best, ["host", "path"], "left")
            .select("page_id", "host", "path", F.concat("best.rule_host", "best.rule_path").alias("rule"),
                    F.coalesce("best.action", F.lit(default)).alias("verdict")))


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, rest, regexp_extract(rest, '^([^/?#]*)', 1, 's') AS raw FROM p),
u AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path FROM h),
r(action, rule_host, rule_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'),
         ('allow', 'org', '/fr/')),
m AS (
  SELECT u.*, r.*, row_number() OVER (PARTITION BY page_id, host, path
           ORDER BY length(rule_host) + length(rule_path) DESC NULLS LAST) AS k
  FROM u LEFT JOIN r ON (u.host = r.rule_host OR u.host LIKE '%.' || r.rule_host)
                    AND starts_with(u.path, r.rule_path))
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(action, 'allow') AS verdict FROM m WHERE k = 1
"""
