"""The answers by month: states that add up, kept beside the fact and refreshed with it.

A state holds counts, sums, squares and products of one month's visits by the keys of a report.
States of any months merge by addition, so an answer over all months reads the states, whose
number goes with months and keys, and a refresh reads the refreshed months of the fact alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.plans import analytics
from starmart.sources.files import save
from starmart.sources.tables import MONTH, in_partitions, upsert_partitions

# The keys of each report's groups.
REPORTS = {
    "nationality": ("i94cit",),
    "origin": ("i94res",),
    "airline": ("airline",),
    "destination": ("i94addr",),
    "route": ("i94addr", "i94res"),
}
KEYS = ("i94cit", "i94res", "airline", "i94addr")


def _measures() -> dict[str, Column]:
    stay, age = F.col("stay").cast("long"), F.col("i94bir").cast("long")
    both = stay.isNotNull() & age.isNotNull()
    none = F.lit(0).cast("long")

    def total(x: Column, where: Column | None = None) -> Column:
        return F.coalesce(F.sum(x if where is None else F.when(where, x)), none)

    return {
        "visits": F.count(F.lit(1)),
        "stays": F.count(stay),
        "stay_sum": total(stay),
        "ages": F.count(age),
        "age_sum": total(age),
        "men": F.count_if(F.col("gender") == "M"),
        "women": F.count_if(F.col("gender") == "F"),
        "unstated": F.count_if(F.col("gender").isNull()),
        "pairs": F.count_if(both),
        "pair_stay": total(stay, both),
        "pair_age": total(age, both),
        "pair_stay_square": total(stay * stay, both),
        "pair_age_square": total(age * age, both),
        "pair_product": total(stay * age, both),
    }


MEASURES = (
    "visits", "stays", "stay_sum", "ages", "age_sum", "men", "women", "unstated", "pairs", "pair_stay",
    "pair_age", "pair_stay_square", "pair_age_square", "pair_product",
)


def month_states(fact: DataFrame) -> DataFrame:
    """(report, keys, measures, month) of the visits that have a month; one pass for all reports.

    Rows are added up in the tasks before they are dealt, so a key with a third of all visits is
    one row a task and report.
    """
    columns = [*MONTH, *KEYS]
    dated = fact.where(F.col(MONTH[0]).isNotNull() & F.col(MONTH[1]).isNotNull())
    sets = [[*MONTH, *keys] for keys in REPORTS.values()]
    # The bits of the grouping number stand for the columns that a group leaves open, the first highest.
    numbers = {
        name: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in (*MONTH, *keys))
        for name, keys in REPORTS.items()
    }
    report = F.lit(None).cast("string")
    for name, number in numbers.items():
        report = F.when(F.col("__group") == number, name).otherwise(report)
    cube = dated.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns])
    states = cube.agg(F.grouping_id().alias("__group"), *[m.alias(name) for name, m in _measures().items()])
    return states.select(report.alias("report"), *KEYS, *MEASURES, *MONTH)


def refresh_reports(
    fact: DataFrame, path: str, months: Sequence[tuple[int, int]] | None = None
) -> DataFrame:
    """Make the states of a stored fact, or replace those of the named months; returns the states.

    Of a fact stored by month only the named months are read. A refresh that is run again leaves
    the same states.
    """
    if months is None:
        save(month_states(fact), path, partition_by=MONTH)
    else:
        upsert_partitions(month_states(fact.where(in_partitions(months))), path, months)
    return fact.sparkSession.read.parquet(path)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merged(states: DataFrame, report: str) -> DataFrame:
    """A report's states added up over the months."""
    own = states.where(F.col("report") == report)
    return own.groupBy(*REPORTS[report]).agg(*[F.sum(m).alias(m) for m in MEASURES])


def visits_by_nationality(states: DataFrame, country: DataFrame) -> DataFrame:
    return analytics._named(merged(states, "nationality").select("i94cit", "visits"), "i94cit", country, "Country")


def visits_by_origin(states: DataFrame, country: DataFrame) -> DataFrame:
    return analytics._named(merged(states, "origin").select("i94res", "visits"), "i94res", country, "Country")


def visits_by_airline(states: DataFrame) -> DataFrame:
    return merged(states, "airline").select("airline", "visits")


def avg_stay_by_state(states: DataFrame, state: DataFrame) -> DataFrame:
    stays = merged(states, "destination").where(F.col("stays") > 0)
    stays = stays.select("i94addr", (F.col("stay_sum") / F.col("stays")).alias("avg_stay"), F.col("stays").alias("visits"))
    return analytics._named(stays, "i94addr", state, "State")


def visitor_profile_by_state(states: DataFrame, state: DataFrame) -> DataFrame:
    profile = merged(states, "destination").select(
        "i94addr",
        "visits",
        F.try_divide("age_sum", "ages").alias("avg_age"),
        (F.col("men") / F.col("visits")).alias("male_share"),
        (F.col("women") / F.col("visits")).alias("female_share"),
        (F.col("unstated") / F.col("visits")).alias("unstated_share"),
    )
    return analytics._named(profile, "i94addr", state, "State")


def corr_dest_source(states: DataFrame) -> DataFrame:
    cells = merged(states, "route").where(F.col("i94addr").isNotNull() & F.col("i94res").isNotNull())
    return analytics.cramers_v(cells.select("i94addr", "i94res", "visits"))


def corr_source_temperature(states: DataFrame, country: DataFrame) -> DataFrame:
    return analytics.temperature_correlation(merged(states, "origin").select("i94res", "visits"), country)


def corr_stay_age(states: DataFrame) -> DataFrame:
    """(pairs, corr) of length of stay and age over all visits that have both, as one row."""
    sums = merged(states, "destination").agg(*[
        F.coalesce(F.sum(F.col(m).cast("double")), F.lit(0.0)).alias(m) for m in MEASURES if m.startswith("pair")])
    n, x, y = F.col("pairs"), F.col("pair_stay"), F.col("pair_age")
    over = n * F.col("pair_product") - x * y
    under = F.sqrt((n * F.col("pair_stay_square") - x * x) * (n * F.col("pair_age_square") - y * y))
    return sums.select(n.cast("long").alias("pairs"), F.try_divide(over, under).alias("corr"))
