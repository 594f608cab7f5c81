"""Versions of the star: what readers see, whatever happens to a publication."""

import os

import pytest
from pyspark.sql import functions as F

from starmart import contracts
from starmart.plans import star
from starmart.sources import Snapshots

VISITS = contracts.IMMIGRATION.schema
DATES = contracts.DATE.schema


def visit(cicid, month, flight="a", **more):
    row = dict.fromkeys([f.name for f in VISITS])
    row |= {"cicid": cicid, "i94yr": 2016, "i94mon": month, "i94cit": 1, "i94res": 1, "i94addr": "CA"}
    row |= {"arrdate": f"2016-{month:02d}-01", "fltno": flight} | more
    return tuple(row[f.name] for f in VISITS)


@pytest.fixture
def tables(spark):
    visits = [visit(i, m) for m in (4, 5, 6) for i in range(10 * m, 10 * m + 5)]
    days = [(f"2016-{m:02d}-01", 1, m, 2016, 1, 1) for m in (4, 5, 6)]
    country = [(1, "One", 10.5, "1N", "2E")]
    state = [("CA", "California", *[1] * 10)]
    return {
        "immigration": spark.createDataFrame(visits, VISITS),
        "date": spark.createDataFrame(days, DATES),
        "country": spark.createDataFrame(country, contracts.COUNTRY.schema),
        "state": spark.createDataFrame(state, contracts.STATE.schema),
    }


def flights(df):
    return {(r["i94mon"], r["fltno"]): r["count"] for r in df.groupBy("i94mon", "fltno").count().collect()}


def test_readers_see_versions_whole(spark, tables, tmp_path):
    root = str(tmp_path / "p")
    with pytest.raises(ValueError, match="nothing is published"):
        star.star_snapshots(spark, root).read()
    with pytest.raises(ValueError, match="missing"):
        star.publish_star(spark, {"state": tables["state"]}, root)
    assert star.publish_star(spark, tables, root, full_checks=True) == 1
    snapshots = star.star_snapshots(spark, root)
    before = snapshots.read()
    assert before["immigration"].schema.simpleString() == VISITS.simpleString()
    may = [visit(50, 5, "b"), visit(70, 7, "stray")]
    assert star.publish_star(spark, {"immigration": spark.createDataFrame(may, VISITS)}, root, [(2016, 5)]) == 2
    assert flights(snapshots.read()["immigration"]) == {(4, "a"): 5, (5, "b"): 1, (6, "a"): 5}
    assert flights(before["immigration"]) == {(4, "a"): 5, (5, "a"): 5, (6, "a"): 5}
    assert snapshots.read()["state"].count() == 1
    assert snapshots.roll_back(1) == 3 and snapshots.versions() == [1, 2, 3]
    assert flights(snapshots.read()["immigration"]) == {(4, "a"): 5, (5, "a"): 5, (6, "a"): 5}
    assert flights(snapshots.read(2)["immigration"])[(5, "b")] == 1
    with pytest.raises(ValueError, match="version 9"):
        snapshots.read(9)


def test_a_month_without_rows_is_empty_from_then_on(spark, tables, tmp_path):
    root = str(tmp_path / "p")
    star.publish_star(spark, tables, root)
    star.publish_star(spark, {"immigration": tables["immigration"].limit(0)}, root, [(2016, 5)])
    assert flights(star.star_snapshots(spark, root).read()["immigration"]) == {(4, "a"): 5, (6, "a"): 5}


def test_a_publication_that_dies_leaves_the_old_version(spark, tables, tmp_path, monkeypatch):
    """Killed while it writes, or between the last table and the switch; the next one works."""
    root = str(tmp_path / "p")
    star.publish_star(spark, tables, root)
    snapshots = star.star_snapshots(spark, root)
    broken = tables["immigration"].withColumn(
        "fltno", F.when(F.col("i94mon") == 6, F.raise_error(F.lit("killed"))).otherwise(F.lit("x")))
    with pytest.raises(Exception, match="killed"):
        star.publish_star(spark, {**tables, "immigration": broken}, root)
    with monkeypatch.context() as m:
        def dies(*_):
            raise KeyboardInterrupt
        m.setattr(Snapshots, "_put", dies)
        with pytest.raises(KeyboardInterrupt):
            star.publish_star(spark, tables, root)
    with pytest.raises(ValueError, match="non_empty"):
        star.publish_star(spark, {"state": tables["state"].limit(0)}, root)
    assert snapshots.versions() == [1] and snapshots.read()["state"].count() == 1
    assert flights(snapshots.read()["immigration"]) == {(4, "a"): 5, (5, "a"): 5, (6, "a"): 5}
    fresh = tables["immigration"].where("i94mon = 4").withColumn("fltno", F.lit("c"))
    assert star.publish_star(spark, {"immigration": fresh}, root, [(2016, 4)]) == 2
    assert len(os.listdir(f"{root}/data")) == 5
    assert len(snapshots.clean_up()) == 3
    assert len(os.listdir(f"{root}/data")) == 2
    assert flights(snapshots.read()["immigration"]) == {(4, "c"): 5, (5, "a"): 5, (6, "a"): 5}
    assert flights(snapshots.read(1)["immigration"])[(4, "a")] == 5
    # Dropping old versions keeps the folders that later ones still list.
    assert snapshots.clean_up(keep=1) == [] and snapshots.versions() == [2]
    assert flights(snapshots.read()["immigration"]) == {(4, "c"): 5, (5, "a"): 5, (6, "a"): 5}


def test_two_publishers_never_both_win(spark, tables, tmp_path):
    root = str(tmp_path / "p")
    star.publish_star(spark, tables, root)
    snapshots = star.star_snapshots(spark, root)

    def meanwhile(_):
        snapshots.roll_back(1)

    with pytest.raises(RuntimeError, match="meanwhile"):
        snapshots.publish({"state": tables["state"]}, check=meanwhile)
    assert snapshots.versions() == [1, 2]


def test_a_month_of_a_version_is_read_alone(spark, tables, tmp_path, plan):
    root = str(tmp_path / "p")
    star.publish_star(spark, tables, root)
    may = star.star_snapshots(spark, root).read()["immigration"].where("i94yr = 2016 AND i94mon = 5")
    assert may.count() == 5
    assert "PartitionFilters: [isnotnull(i94yr" in plan(may)
