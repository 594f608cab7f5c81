"""Month states: equal to the full recompute, and read by month."""

import pytest
from pyspark.sql import functions as F

from starmart.plans import analytics, reports
from starmart.sources import save, upsert_partitions
from starmart.sources.tables import MONTH, in_partitions


@pytest.fixture
def fact(spark):
    rows = [
        (
            i, 2016 + (i % 24) // 12, 1 + i % 12, i % 5, i % 7 if i % 11 else None,
            None if i % 13 == 0 else f"S{i % 3 if i % 2 else 0}", None if i % 17 == 0 else f"A{i % 4}",
            None if i % 19 == 0 else i % 30 - 3, None if i % 23 == 0 else i % 80, "MF"[i % 2] if i % 6 else None,
        )
        for i in range(2000)
    ]
    names = (
        "cicid int, i94yr int, i94mon int, i94cit int, i94res int, i94addr string, airline string, "
        "stay int, i94bir int, gender string"
    )
    return spark.createDataFrame(rows, names)


@pytest.fixture
def dims(spark):
    country = spark.createDataFrame([(i, f"C{i}", 3.5 * i if i != 2 else None) for i in range(6)], "Code int, Country string, Temperature double")
    state = spark.createDataFrame([("S0", "zero"), ("S1", "one")], "Code string, State string")
    return country, state


def answers(rows, fact, states, country, state):
    """Pairs of results that must be equal."""
    def got(df):
        return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows(df)]

    return [
        (got(analytics.visits_by_nationality(fact, country)), got(reports.visits_by_nationality(states, country))),
        (got(analytics.visits_by_origin(fact, country)), got(reports.visits_by_origin(states, country))),
        (got(analytics.visits_by_airline(fact)), got(reports.visits_by_airline(states))),
        (got(analytics.avg_stay_by_state(fact, state)), got(reports.avg_stay_by_state(states, state))),
        (got(analytics.visitor_profile_by_state(fact, state)), got(reports.visitor_profile_by_state(states, state))),
        (got(analytics.corr_dest_source(fact)), got(reports.corr_dest_source(states))),
        (got(analytics.corr_source_temperature(fact, country)), got(reports.corr_source_temperature(states, country))),
        (
            got(fact.where("stay IS NOT NULL AND i94bir IS NOT NULL").agg(F.count("*"), F.corr("stay", "i94bir"))),
            got(reports.corr_stay_age(states)),
        ),
    ]


def test_two_refreshes_equal_the_full_recompute(spark, fact, dims, tmp_path, rows):
    path, states = str(tmp_path / "v"), str(tmp_path / "s")
    save(fact, path, partition_by=MONTH)
    reports.refresh_reports(spark.read.parquet(path), states)
    first = fact.where("i94yr = 2016 AND i94mon IN (2, 3)").withColumns({"stay": F.col("stay") * 2, "airline": F.lit("new")})
    second = fact.where("i94yr = 2017 AND i94mon = 3 AND cicid % 2 = 0").withColumn("i94res", F.lit(3))
    for rows_, months in ((first, [(2016, 2), (2016, 3)]), (second, [(2017, 3)]), (second, [(2017, 3)])):
        upsert_partitions(rows_, path, months)
        reports.refresh_reports(spark.read.parquet(path), states, months)
    for want, got in answers(rows, spark.read.parquet(path), reports.read_states(spark, states), *dims):
        assert want == got and want


def test_a_refresh_reads_its_months_alone(spark, fact, tmp_path, plan):
    path = str(tmp_path / "v")
    save(fact, path, partition_by=MONTH)
    months = spark.read.parquet(path).where(in_partitions([(2016, 2)]))
    states = reports.month_states(months)
    assert states.select("i94yr", "i94mon").distinct().count() == 1
    scan = next(line for line in plan(states).splitlines() if "Scan parquet" in line)
    assert "PartitionFilters: []" not in scan and "cicid" not in scan.split("ReadSchema")[1]
    assert plan(states).count("Scan parquet") == 1


def test_visits_without_a_month_are_in_no_state(spark, fact):
    undated = fact.withColumn("i94mon", F.lit(None).cast("int"))
    assert reports.month_states(undated).count() == 0
    assert reports.month_states(fact.limit(0)).count() == 0
