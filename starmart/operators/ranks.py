"""Orders over whole tables without a window over all rows: ranges, and what they carry on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.session import scratch_dir


def carried_sum(df: DataFrame, range_by: str, order_by: str, value: Column, output: str) -> DataFrame:
    """Adds the running sum of ``value`` by ``order_by``, which rises with ``range_by``.

    Ranges are summed on their own; each then starts from the sum of all before it. Only the
    ranges' totals, a row each, meet in one place.
    """
    valued = df.withColumn("__value", value)
    totals = valued.groupBy(F.col(range_by).alias("__range")).agg(F.sum("__value").alias("__total"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("__range", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy(range_by).orderBy(order_by).rowsBetween(Window.unboundedPreceding, 0)
    return (
        valued.join(starts, F.col(range_by).eqNullSafe(F.col("__range")))
        .withColumn(output, F.col("__start") + F.sum("__value").over(within))
        .drop("__value", "__range", "__start")
    )


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def average_ranks(counts: DataFrame, value: str, n: str = "n") -> DataFrame:
    """(value, rank) from distinct values and how often each occurs; equal values share the mean
    of their ranks. Values are dealt by range into as many tasks as the session shuffles to, and
    stored so that the ranges stay what they are."""
    ranged = counts.repartitionByRange(value).withColumn("__piece", F.spark_partition_id())
    summed = carried_sum(_stored(ranged, "ranges"), "__piece", value, F.col(n), "__upto")
    rank = F.col("__upto") - F.col(n) + (F.col(n) + 1) / 2
    return summed.select(value, rank.alias("rank"))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """(rows, rho) where both columns are filled; rho is NULL where one does not vary.

    ``df`` is read once, for the counts of pairs of values. The ranks come from those, and are
    joined back by value. Ranks are taken from their mean, which is known beforehand.
    """
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    cells = _stored(
        both.groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(F.count(F.lit(1)).alias("n")), "cells")
    total = cells.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    for side in ("x", "y"):
        ranks = average_ranks(cells.groupBy(side).agg(F.sum("n").alias("n")), side)
        away = F.col("rank") - (total + 1) / 2
        cells = cells.join(ranks.select(F.col(side).alias("__v"), away.alias(f"r{side}")), F.col(side) == F.col("__v")).drop("__v")
    n, a, b = F.col("n").cast("double"), F.col("rx"), F.col("ry")
    sums = cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.sum(n * a * b).alias("ab"), F.sum(n * a * a).alias("aa"), F.sum(n * b * b).alias("bb"),
    )
    return sums.select("rows", F.try_divide("ab", F.sqrt(F.col("aa") * F.col("bb"))).alias("rho"))
