import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from starmart.operators import aggregates, dims, facts

DEMOGRAPHICS = (
    "City string, State string, `Median Age` string, `Male Population` string, "
    "`Female Population` string, `Total Population` string, `Number of Veterans` string, "
    "`Foreign-born` string, `Average Household Size` string, `State Code` string, "
    "Race string, Count string"
)
CITIES = [
    ("Salem", "Oregon", "35.5", "40", "60", "100", "7", "3", "2.5", "OR", "White", "80"),
    ("Salem", "Oregon", "35.5", "40", "60", "100", "7", "3", "2.5", "OR", "Asian", "20"),
    ("Bend", "Oregon", "38.1", "10", "15", "25", None, "1", None, "OR", "White", "25"),
    ("Austin", "Texas", "33.0", "5", "6", "11", "2", "2", "2.0", "TX", "Hispanic or Latino", "9"),
    ("Nowhere", None, "1", "1", "1", "2", "1", "1", "1", "ZZ", "White", "1"),
]
TEMPERATURES = (
    "dt string, AverageTemperature string, City string, Country string, "
    "Latitude string, Longitude string"
)


def _readings():
    place = {"Kinshasa": ("4S", "15E"), "Brazzaville": ("4S", "14E"), "Lima": ("12S", "77W")}
    data = [
        ("1900-01-01", "20", "Kinshasa", "Congo (Democratic Republic Of The)"),
        ("1900-02-01", "22", "Kinshasa", "Congo (Democratic Republic Of The)"),
        ("1900-01-01", "30", "Brazzaville", "Congo"),
        ("1900-02-01", None, "Brazzaville", "Congo"),
        ("1900-01-01", "bad", "Lima", "Peru"),
        ("1900-02-01", "", "Lima", "Peru"),
    ]
    return [(*row, *place[row[2]]) for row in data]


def test_fact(spark):
    raw = spark.createDataFrame(
        [("6.0", "20551.0", "20573.0", "CA", "LA", "2016.0", "4.0", "x")],
        "cicid string, arrdate string, depdate string, i94addr string, airline string, "
        "i94yr string, i94mon string, occup string",
    )
    fact = facts.visits(raw, None)
    row = fact.first()
    assert "occup" not in fact.columns
    assert (row.cicid, row.i94yr, row.i94mon, row.stay) == (6, 2016, 4, 22)
    assert (row.arrdate, row.depdate) == (dt.date(2016, 4, 7), dt.date(2016, 4, 29))


def test_date_dim_is_unique_and_filled(spark, rows):
    a, b = dt.date(2016, 4, 1), dt.date(2016, 4, 3)
    fact = spark.createDataFrame([(a, b), (b, None), (a, a)], "arrdate date, depdate date")
    assert rows(dims.date_dim(fact)) == [(a, 2016, 4, 1, 13, 6), (b, 2016, 4, 3, 13, 1)]
    union = rows(aggregates.date_union(fact, ["arrdate", "depdate"]))
    assert union == [(a,), (a,), (b,), (b,), (None,)]


def test_city_demographics(spark):
    cities = dims.city_demographics(spark.createDataFrame(CITIES, DEMOGRAPHICS))
    got = {r.City: r.asDict() for r in cities.collect()}
    assert sorted(got) == ["Austin", "Bend", "Salem"]
    salem, bend = got["Salem"], got["Bend"]
    assert (salem["White"], salem["Asian"], salem["HispanicOrLatino"]) == (80, 20, 0)
    assert (salem["TotalPopulation"], salem["MedianAge"]) == (100, 35.5)
    assert (bend["NumberVeterans"], bend["AverageHouseholdSize"]) == (0, 0.0)
    types = dict(cities.dtypes)
    assert types["White"] == "bigint" and types["TotalPopulation"] == "int"


def test_city_demographics_equals_pivot_and_join(spark, rows):
    raw = spark.createDataFrame(CITIES, DEMOGRAPHICS)
    raw = raw.withColumn("Count", dims.int_from_text("Count"))
    pivoted = aggregates.pivot_sum(raw, dims.CITY_KEYS, "Race", "Count", dims.RACES).fillna(0)
    names = [*dims.CITY_KEYS, *dims.RACES.values()]
    columns = [f"`{n}`" for n in names]
    got = rows(dims.city_demographics(raw), *columns)
    assert got == rows(pivoted.where("State is not null"), *columns)


def test_pivot_without_values_takes_all_that_occur(spark, rows):
    data = [(1, "x y", 2), (1, "z", 3), (2, "z", 4), (2, "z", 5)]
    df = spark.createDataFrame(data, "k int, c string, n int")
    pivoted = aggregates.pivot_sum(df, ["k"], "c", "n")
    assert pivoted.columns == ["k", "x y", "z"]
    assert rows(pivoted) == [(1, 2, 3), (2, None, 9)]


def test_states_sum_to_the_cities(spark):
    cities = dims.city_demographics(spark.createDataFrame(CITIES, DEMOGRAPHICS))
    totals = [F.sum(m) for m in dims.STATE_MEASURES]
    assert dims.state_rollup(cities).agg(*totals).first() == cities.agg(*totals).first()


def test_state_dim_keeps_every_code_and_totals(spark):
    cities = dims.city_demographics(spark.createDataFrame(CITIES, DEMOGRAPHICS))
    lookup = spark.createDataFrame(
        [("OR", "OREGON"), ("NY", "NEW\u00a0YORK")], "Code string, State string"
    )
    got = {r.Code: r for r in dims.state_dim(cities, lookup).collect()}
    assert got["OR"].TotalPopulation == 125 and got["OR"].White == 105
    assert got["OR"].State == "Oregon"
    assert got["NY"].State == "New\u00a0York" and got["NY"].TotalPopulation is None
    clean = dims.state_dim(cities, lookup, normalize_space=True).where("Code = 'NY'").first()
    assert clean.State == "New York"


def test_country_dim_merges_overridden_names(spark):
    lookup = spark.createDataFrame(
        [
            ("385", "CONGO"),
            ("574", "INVALID: CANADA"),
            ("0", "INVALID: STATELESS"),
            ("692", "PERU"),
        ],
        "Code string, I94CTRY string",
    )
    data = _readings()
    want = None
    for seed in range(3):
        random.Random(seed).shuffle(data)
        readings = spark.createDataFrame(data, TEMPERATURES).repartition(3)
        got = sorted(tuple(r) for r in dims.country_dim(readings, lookup).collect())
        assert want in (None, got)
        want = got
    assert got == [
        (0, "Invalid: Stateless", None, None, None),
        (385, "Congo", pytest.approx(24.0), "4S", "14E"),
        (574, "Canada", None, None, None),
        (692, "Peru", None, "12S", "77W"),
    ]


def test_country_with_a_third_of_all_readings(spark):
    n = 3000
    big = [("d", str(i % 7), f"c{i % 5}", "Peru", "1", "2") for i in range(n)]
    rest = [("d", "5", f"x{i}", f"land {i % 50}", "1", "2") for i in range(2 * n)]
    readings = spark.createDataFrame(big + rest, TEMPERATURES)
    got = {r.Country: r.Temperature for r in dims.country_temperature(readings).collect()}
    assert len(got) == 51
    assert got["Peru"] == pytest.approx(sum(i % 7 for i in range(n)) / n)
    assert got["land 3"] == pytest.approx(5.0)


def test_categories_found_in_the_data(spark, rows):
    odd = ("Reno", "Nevada", "30", "5", "6", "11", "2", "2", "2.0", "NV", "Other", "11")
    df = spark.createDataFrame([*CITIES, odd], DEMOGRAPHICS)
    cities = dims.city_demographics(df, races=None)
    assert {"Other", "White", "Hispanic or Latino"} <= set(cities.columns)
    assert rows(cities.where("City = 'Reno'"), "Other", "White") == [(11, 0)]


def test_two_spellings_of_a_state_make_one_row(spark, rows):
    odd = ("Eugene", "OREGON", "30", "5", "6", "11", "2", "2", "2.0", "OR", "White", "11")
    cities = dims.city_demographics(spark.createDataFrame([*CITIES, odd], DEMOGRAPHICS))
    lookup = spark.createDataFrame([("OR", "OREGON")], "Code string, State string")
    got = rows(dims.state_dim(cities, lookup), "Code", "State", "TotalPopulation")
    assert got == [("OR", "OREGON", 136)]
