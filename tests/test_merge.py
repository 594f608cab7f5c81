"""Corrections by key, name candidates and column sketches against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from starmart import contracts
from starmart.operators import names, sketches
from starmart.sources import KeyIndex, Snapshots, merge_rows
from starmart.sources.tables import MONTH

CONTRACT = contracts.TableContract(
    "visits", contracts.StructType([
        contracts.StructField("cicid", contracts.IntegerType()),
        contracts.StructField("flight", contracts.StringType()),
        contracts.StructField("i94yr", contracts.IntegerType()),
        contracts.StructField("i94mon", contracts.IntegerType()),
    ]), ("cicid",))


@pytest.fixture
def published(spark, tmp_path):
    """Twelve months of keys that lie apart and two that overlap, one with most of the rows."""
    rows = spark.range(6000).selectExpr(
        "cast(id * 3 as int) AS cicid", "'a' AS flight", "2016 AS i94yr", "cast(least(id div 400, 11) + 1 as int) AS i94mon")
    extra = spark.range(500).selectExpr("cast(id * 9 + 1 as int) AS cicid", "'a' AS flight", "2017 AS i94yr", "1 AS i94mon")
    snapshots = Snapshots(spark, str(tmp_path / "p"), {"visits": CONTRACT}, {"visits": MONTH})
    snapshots.publish({"visits": rows.unionByName(extra)})
    return snapshots


def frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, "cicid int, flight string, i94yr int, i94mon int" + extra)


def content(snapshots, version=None):
    return sorted(tuple(r) for r in snapshots.read(version)["visits"].collect())


def test_only_touched_months_are_read_and_rewritten(spark, published):
    index = KeyIndex(published, "visits", "cicid")
    assert index.partitions_of(frame(spark, [(3 * 450, "b", 2016, 2)])) == [(2016, 2)]
    assert index.partitions_of(frame(spark, [(2, "b", 2016, 2), (10**9, "b", 2016, 2)])) == []
    every = frame(spark, [(3 * i, "b", 1, 1) for i in range(0, 6000, 100)])
    assert index.partitions_of(every) == [(2016, m) for m in range(1, 13)]
    before = published.manifest().folders["visits"]
    version, touched = merge_rows(published, "visits", frame(spark, [(3 * 450, "b", 2016, 2), (3 * 451, "b", 2016, 5)]), "cicid")
    assert version == 2 and touched == [(2016, 2), (2016, 5)]
    after = published.manifest().folders["visits"]
    assert len(set(before) - set(after)) == 2 and len(after) == len(before)
    want = {r[0]: r for r in content(published, 1)} | {1350: (1350, "b", 2016, 2), 1353: (1353, "b", 2016, 5)}
    assert content(published) == sorted(want.values())


def test_the_latest_of_a_key_wins_and_again_changes_nothing(spark, published):
    rows = [(9, "x", 2016, 1, 2), (9, "y", 2016, 3, 1), (12, "p", 2016, 1, 1), (12, "q", 2016, 1, 1), (7, "new", 2018, 1, 5), (10, "z", 2017, 1, 1)]
    delivery = frame(spark, rows, ", n int")
    merge_rows(published, "visits", delivery, "cicid", ["n"])
    once = content(published)
    found = {r[0]: r for r in once}
    assert len(found) == len(once) == 6501
    assert [found[k][1:] for k in (9, 12, 7, 10)] == [("x", 2016, 1), ("q", 2016, 1), ("new", 2018, 1), ("z", 2017, 1)]
    version, touched = merge_rows(published, "visits", delivery, "cicid", ["n"])
    assert content(published) == once and version == 3 and (2018, 1) in touched and len(touched) <= 4
    with pytest.raises(ValueError, match="2 rows have no"):
        merge_rows(published, "visits", frame(spark, [(None, "a", 2016, 1), (1, "a", 2016, None)]), "cicid")
    assert merge_rows(published, "visits", frame(spark, []), "cicid")[1] == []
    assert content(published) == once


def test_an_index_loses_no_key_and_finds_few_others(spark, published):
    index = KeyIndex(published, "visits", "cicid")
    index.build()
    rows = published.read()["visits"]
    rng = random.Random(1)
    held = {r["cicid"]: (r["i94yr"], r["i94mon"]) for r in rows.collect()}
    for key in rng.sample(sorted(held), 8):
        assert held[key] in index.partitions_of(frame(spark, [(key, "", 1, 1)]))
    strange = [3 * i + 2 for i in range(6000)]
    alone = [index.partitions_of(frame(spark, [(k, "", 1, 1)])) for k in rng.sample(strange, 8)]
    assert sum(map(len, alone)) <= 1


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_names_equal_brute_force(spark):
    rng = random.Random(8)
    letters = "abcde éß"
    known = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 14))) for _ in range(250)] + ["WISCONSON", "KOREA, REPUBLIC", "aaaaaaaaaa"]
    wanted = []
    for k in known * 2:
        t = list(k)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(t) + 1)
            t[at : at + rng.randrange(2)] = rng.choice(["", "x", "a"])
        wanted.append("".join(t))
    wanted += ["Wisconsin", "Korea Republic", "korea, republic", None, "", "aaaaaaaaa", "aaaaaaaaaaaa"]
    df = spark.createDataFrame([(w,) for w in wanted], "n string").repartition(3)
    other = spark.createDataFrame([(k,) for k in [*known, None]], "k string")
    got = sorted(tuple(r) for r in names.name_candidates(df, other, "n", "k").collect())
    lower = {k.lower() for k in known}
    want = sorted(
        (w, k, d) for w in {w for w in wanted if w is not None and w.lower() not in lower} for k in set(known)
        if (d := distance(w.lower(), k.lower())) <= min(2, (max(len(w), len(k)) - 1) // 4))
    assert got == want and ("Wisconsin", "WISCONSON", 1) in got and ("Korea Republic", "KOREA, REPUBLIC", 1) in got


def test_names_meet_by_trigram(spark, plan):
    df = spark.createDataFrame([("a",)], "n string")
    text = plan(names.name_candidates(df, df.withColumnRenamed("n", "k"), "n", "k"))
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_merged_sketches_say_what_one_built_at_once_says(spark, tmp_path):
    rows = spark.range(30_000).selectExpr(
        "id AS a", "cast(id % 700 as string) AS b", "if(id % 10 = 0, null, cast(id * id % 9973 as int)) AS c",
        "2016 AS i94yr", "cast(id % 12 + 1 as int) AS i94mon")
    columns, numbers = ["a", "b", "c"], ["a", "c"]
    whole = sketches.month_sketches(rows.withColumns({"i94yr": F.lit(1), "i94mon": F.lit(1)}), columns, numbers)
    path = str(tmp_path / "s")
    sketches.refresh_sketches(rows, path, columns, numbers)
    again = sketches.refresh_sketches(rows, path, columns, numbers, [(2016, 4), (2016, 5)])
    assert again.count() == 36
    once, merged = ({r["column"]: r for r in sketches.sketch_profile(s).collect()} for s in (whole, again))
    for c, values, nulls in (("a", 30_000, 0), ("b", 700, 0), ("c", None, 3_000)):
        assert merged[c]["rows"] == once[c]["rows"] == 30_000 and merged[c]["nulls"] == once[c]["nulls"] == nulls
        assert abs(once[c]["distinct"] - merged[c]["distinct"]) <= 0.02 * once[c]["distinct"]
        assert values is None or abs(merged[c]["distinct"] - values) <= 0.05 * values
    assert merged["b"]["quantiles"] is None
    for q, value in zip(sketches.QUANTILES, merged["a"]["quantiles"], strict=True):
        assert abs(value / 30_000 - q) <= sketches.RANK_ERROR
    empty = sketches.month_sketches(rows.limit(0), columns, numbers)
    assert sketches.sketch_profile(empty).count() == 0
    nothing = sketches.month_sketches(rows.withColumn("c", F.lit(None).cast("int")), columns, numbers)
    assert {r["column"]: r["quantiles"] is None for r in sketches.sketch_profile(nothing).collect()} == {"a": False, "b": True, "c": True}
