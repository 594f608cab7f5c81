"""Every registered query: its SQL result, and the plan it runs by."""

import os

import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry
from starmart.operators import dims
from starmart.samples import views
from starmart.samples.oracles import ORACLES
from starmart.samples.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = sorted(QUERIES)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys()


def test_flagship(spark):
    assert entry.entry(spark).columns == ["i94cit", "visits", "Country"]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, plan, name):
    """Equals its SQL, stays in the JVM, and joins on keys only."""
    df = entry.queries()[name](spark, SF_DIR)
    text = plan(df)
    for operator in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text
    assert compare(df, con, name) is None


def test_city_demographics_groups_once(spark, plan):
    """The race columns cost no second aggregation of the source and no join."""
    raw = views.demographics_raw(spark, SF_DIR)
    before = plan(raw).count("Exchange hashpartitioning")
    after = plan(dims.city_demographics(raw, races=views.RACES))
    assert after.count("Exchange hashpartitioning") == before + 1
    assert after.count("Join") == plan(raw).count("Join")


def test_scans_read_only_what_is_asked(spark, plan):
    text = plan(entry.queries()["visits_by_airline"](spark, SF_DIR))
    assert "o_totalprice" not in text and "l_shipdate" not in text and "s_nationkey" not in text


@pytest.mark.parametrize("columns", [["Temperature", "Latitude"], ["Country"]])
def test_readings_are_summed_by_hash(spark, plan, columns):
    """The pass over the readings needs no sort, whatever is read of the result."""
    climates = dims.country_temperature(views.temperature_raw(spark, SF_DIR))
    text = plan(climates.select("country_key", *columns))
    lines = [line for line in text.splitlines() if "Aggregate(" in line]
    per_city = [line for line in lines if "City" in line.split("functions=")[0]]
    assert len(per_city) == 2 and all("HashAggregate" in line for line in per_city)


def test_star_checks_join_the_arrivals_once(spark, monkeypatch):
    made = []
    real = views.visits_raw
    monkeypatch.setattr(views, "visits_raw", lambda *a: made.append(a) or real(*a))
    rows = QUERIES["star_checks"](spark, SF_DIR).collect()
    assert len(made) == 1 and all(r["passed"] for r in rows if r["table"] == "date")
