"""URL filters: rules by host and path, matched by hashed expressions.

A URL is expanded into every host suffix joined with every path prefix that ends in a slash.
Rules carry the same kind of expression, so matching is an equi-join on the first bytes of its
hash, and the full digest and the rule's own path confirm each hit.

A host of many labels or a path of many steps is expanded no further than the longest rule
reaches: longer suffixes and deeper prefixes can equal no rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
SHORT = 8  # hex digits of the join key

# (action, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "action string, rule_host string, rule_path string")


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def _folder(path: str) -> Column:
    """The path up to its last slash, that included; empty without a slash."""
    return F.regexp_extract(path, r"(?s)^(.*/)", 1)


def _keyed(df: DataFrame) -> DataFrame:
    df = df.withColumn("digest", F.sha2("expression", 256))
    return df.withColumn("short", F.substring("digest", 1, SHORT))


def _prepared(rules: DataFrame) -> DataFrame:
    """One row per host and path; where the actions differ, block wins."""
    whole = rules.where(F.col("rule_host").isNotNull() & (F.col("rule_host") != ""))
    named = whole.select(
        "action",
        F.translate("rule_host", UPPER, LOWER).alias("rule_host"),
        F.coalesce("rule_path", F.lit("")).alias("rule_path"),
    )
    one = named.groupBy("rule_host", "rule_path").agg(F.max("action").alias("action"))
    return _keyed(one.withColumn("expression", F.concat("rule_host", _folder("rule_path"))))


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The winning rule of each distinct (host, path) that any rule fits.

    The longest rule string wins, then the longer host.
    """
    prepared = _prepared(rules)
    reach = prepared.agg(
        F.max(F.size(F.split("rule_host", "[.]"))).alias("labels"),
        F.max(F.length(_folder("rule_path"))).alias("chars"),
    ).first()
    labels, chars = reach["labels"] or 0, reach["chars"] or 0
    expanded = (
        urls.where("host != ''")
        .select("host", "path")
        .distinct()
        .withColumn("labels", F.reverse(F.slice(F.reverse(F.split("host", "[.]")), 1, max(labels, 1))))
        .withColumn("steps", F.split(F.substring("path", 1, chars), "/"))
        .withColumn("suffixes", F.expr(
            "transform(labels, (x, i) -> array_join(slice(labels, i + 1, size(labels)), '.'))"))
        .withColumn("prefixes", F.expr(
            "transform(steps, (x, i) -> array_join(slice(steps, 1, i), '/') || if(i > 0, '/', ''))"))
        .withColumn("expression", F.explode(F.expr(
            "flatten(transform(suffixes, s -> transform(prefixes, p -> s || p)))")))
        .select("host", "path", "expression")
    )
    hits = _keyed(expanded).alias("u").join(prepared.alias("r"), "short")
    hits = hits.where("u.digest = r.digest AND startswith(path, rule_path)")
    rule = F.struct(
        F.length(F.concat("rule_host", "rule_path")).alias("n"),
        F.length("rule_host").alias("n_host"),
        F.concat("rule_host", "rule_path").alias("rule"),
        "action",
    )
    best = hits.groupBy("host", "path").agg(F.max(rule).alias("best"))
    return best.select("host", "path", "best.rule", "best.action")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Each page's host, path, winning rule and verdict.

    A null URL or one without ``://`` has an empty host and path, fits no rule and gets
    ``default``. Repeated pages each get a row; columns other than page_id and url are not kept.
    An empty rule table leaves every page at ``default``.
    """
    parsed = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    found = matches(parsed, rules)
    return parsed.join(found, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict"))


ORACLE = r"""
WITH rules(action, rule_host, rule_path) AS (VALUES
  ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
  ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
parsed AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
best AS (
  SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(action, length(rule_host || rule_path)) AS action
  FROM (SELECT DISTINCT host, path FROM parsed) JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path)
SELECT page_id, p.host, p.path, rule, coalesce(action, 'allow') AS verdict
FROM parsed p LEFT JOIN best b ON p.host = b.host AND p.path = b.path
"""


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starmart.llm.store import table

    return judge(table(spark, sf_dir, "pages"), rule_table(spark))
