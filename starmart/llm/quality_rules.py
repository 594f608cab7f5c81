"""Quality rules: counts per document, and verdicts on the hosts that documents come from.

Each document is counted in its own row. Rule failures are then summed by host, the failure
rates shrunk towards the corpus by a beta prior fitted to the hosts themselves, and hosts that
fail beyond doubt are rejected with all their documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.store import SPACE, table, text_of, words_of, written

WINDOW = 8


def counts(docs: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Counts per document beside ``doc``, a struct of the carried columns, and ``host``.

    A null text has no words. A window of eight words is known by a 64-bit hash; n_repeat_words
    sorts a text's windows by hash, keeps those with an equal neighbour, and adds up the words
    they cover.
    """
    words = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("doc"),
        F.col("source").cast("string").alias("host"),
        text_of().alias("body"),
        words_of(text_of()).alias("words"),
    )
    hashed = words.select(
        "doc",
        "host",
        F.expr("filter(split(body, '\\n', -1), x -> x rlike '[^" + SPACE.replace("\\", "\\\\") + "]')").alias("lines"),
        F.length(F.regexp_replace("body", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("words").cast("long").alias("n_words"),
        F.expr("aggregate(words, 0L, (n, w) -> n + length(w))").alias("word_chars"),
        F.expr("transform(words, w -> xxhash64(w))").alias("marks"),
    )
    windows = hashed.select(
        "*",
        F.expr(
            f"if(n_words < {WINDOW}, array(), transform(sequence(1, cast(n_words as int) - {WINDOW - 1}),"
            f" i -> xxhash64(slice(marks, i, {WINDOW}))))"
        ).alias("windows"),
    )
    ordered = windows.select(
        "*",
        F.expr(
            "if(size(array_distinct(windows)) = size(windows), null,"
            " sort_array(transform(windows, (h, i) -> struct(h, i))))"
        ).alias("ordered"),
    )
    repeated = ordered.select(
        "*",
        F.expr(
            "sort_array(transform(filter(ordered, (x, i) -> coalesce(x.h = get(ordered, i - 1).h, false)"
            " OR coalesce(x.h = get(ordered, i + 1).h, false)), x -> x.i))"
        ).alias("at"),
    )
    return repeated.select(
        "doc",
        "host",
        "n_words",
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            f"coalesce(aggregate(transform(at, (x, i) -> least({WINDOW}, get(at, i + 1) - x)), 0L, (a, b) -> a + b), 0L)"
        ).alias("n_repeat_words"),
    )


def host_rates(judged: DataFrame) -> DataFrame:
    """Failures per host, and the rate after shrinkage with its standard deviation.

    The prior is Beta(a, b) with the mean of all documents and a strength found from how the
    hosts' rates vary: the less they vary, the more a host of few documents is drawn to the mean.
    """
    hosts = judged.where("host IS NOT NULL").groupBy("host").agg(
        F.count("*").alias("n"), F.count_if("failed").alias("n_failed"))
    hosts = written(hosts, "hosts")
    overall = hosts.agg(
        F.sum("n_failed").alias("failed"),
        F.sum("n").alias("n"),
        F.var_pop(F.col("n_failed") / F.col("n")).alias("spread"),
    ).first()
    total, spread = overall["n"] or 1, overall["spread"] or 0.0
    mean = min(max((overall["failed"] or 0) / total, 1e-6), 1 - 1e-6)
    strength = min(max(mean * (1 - mean) / spread - 1, 2.0), 1000.0) if spread > 0 else 1000.0
    n, rate = F.col("n") + F.lit(strength), F.col("rate")
    shrunk = hosts.withColumn("rate", (F.col("n_failed") + F.lit(mean * strength)) / n)
    return shrunk.withColumn("deviation", F.sqrt(rate * (1 - rate) / (n + 1)))


def judge(
    docs: DataFrame,
    carry: Sequence[str] = ("doc_id",),
    least_words: int = 20,
    most_repeated: int = 30,
    host_limit: float = 0.5,
) -> DataFrame:
    """Counts and verdicts per document, with ``doc`` a struct of the carried columns.

    base_failed: under ``least_words`` words, or more than ``most_repeated`` per cent of them in
    repeated windows. For the hosts, a document also fails with more than one symbol to two
    words or with over half of its lines repeated. A host is rejected if its shrunk rate less
    two standard deviations is above ``host_limit``. Null texts fail the base rules; documents
    of no source are judged by the base rules alone. Repeated rows are judged one by one.
    """
    base = (F.col("n_words") < least_words) | (
        100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    judged = counts(docs, carry).withColumn("base_failed", base).withColumn(
        "failed",
        F.col("base_failed")
        | (2 * F.col("n_symbols") > F.col("n_words"))
        | (2 * F.col("n_dup_lines") > F.col("n_lines")),
    )
    judged = written(judged, "judged")
    rejected = host_rates(judged).where(F.col("rate") - 2 * F.col("deviation") > host_limit)
    known = judged.join(rejected.select("host", F.lit(True).alias("host_failed")), "host", "left")
    return known.select(
        "doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("host_failed").isNull()).alias("kept"),
    )


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, with the columns of documents."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    return judge(docs, columns).where("kept").select("doc.*")


ORACLE = r"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM base),
grams AS (
  SELECT r, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) >= 8),
hashed AS (SELECT r, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS g FROM grams),
often AS (SELECT r, i FROM hashed QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
spread AS (
  SELECT r, least(8, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 8)) AS n FROM often),
repeated AS (SELECT r, sum(n)::BIGINT AS n FROM spread GROUP BY r),
c AS (
  SELECT doc_id, source, len(ws)::BIGINT AS n_words,
    length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN repeated USING (r)),
j AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    base_failed OR 2 * n_symbols > n_words OR 2 * n_dup_lines > n_lines AS failed FROM c),
h AS (
  SELECT source, count(*) AS n, count(*) FILTER (WHERE failed) AS f
  FROM j WHERE source IS NOT NULL GROUP BY source),
o AS (
  SELECT least(greatest(sum(f) / sum(n), 1e-6), 1 - 1e-6) AS m, var_pop(f / n) AS v FROM h),
k AS (
  SELECT m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 2.0), 1000.0) ELSE 1000.0 END AS s FROM o),
p AS (SELECT source, n + s AS n, (f + m * s) / (n + s) AS rate FROM h, k),
bad AS (SELECT source FROM p WHERE rate - 2 * sqrt(rate * (1 - rate) / (n + 1)) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (source IS NULL OR source NOT IN (SELECT source FROM bad)) AS kept
FROM j
"""


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"))
    return judged.select("doc.doc_id", *[c for c in judged.columns if c != "doc"])
