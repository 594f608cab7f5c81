import pytest
from pyspark.sql import functions as F

from starmart import contracts
from starmart.operators import quality


def test_non_empty_and_assert(spark, rows):
    tables = {"a": spark.range(3), "b": spark.range(0)}
    report = quality.non_empty(tables)
    assert rows(report) == [("a", "non_empty", 3, True), ("b", "non_empty", 0, False)]
    with pytest.raises(ValueError, match="b: non_empty observed 0"):
        quality.assert_passed(report)
    quality.assert_passed(quality.non_empty({"a": spark.range(1)}))


def test_duplicates(spark, rows):
    data = [(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")]
    df = spark.createDataFrame(data, "k int, v string")
    assert rows(quality.duplicate_keys(df, ["k"])) == [(1, 3), (None, 2)]
    assert rows(quality.duplicate_rows(df)) == [(5, 3, 2)]
    assert rows(quality.duplicate_rows(df.limit(0))) == [(0, 0, 0)]


def test_duplicates_with_one_key_on_a_third_of_all_rows(spark, rows):
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    df = spark.range(30000).select(key.alias("k"))
    assert rows(quality.duplicate_keys(df, ["k"])) == [(-1, 10000)]


def test_null_profile_and_drop(spark, rows):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "a int, b string")
    assert rows(quality.null_profile(df)) == [("a", 3, 0, 0.0), ("b", 3, 2, pytest.approx(2 / 3))]
    assert quality.drop_high_null(df, 0.5).columns == ["a"]
    assert quality.drop_high_null(df, 0.7).columns == ["a", "b"]
    assert rows(quality.null_profile(df.limit(0)))[0] == ("a", 0, 0, None)


def test_cast_failures(spark, rows):
    data = [("4.0", "x"), (None, "1"), ("", "2"), ("4.7", "4.7")]
    df = spark.createDataFrame(data, "a string, b string")
    got = rows(quality.cast_failures(df, {"a": "int", "b": "double", "zz": "int"}))
    assert got == [("a", "int", 3, 2), ("b", "double", 4, 1)]


def test_unknown_categories(spark, rows):
    df = spark.createDataFrame([("a", "1"), ("b", "2"), ("b", "3"), (None, "x")], "c string, n string")
    assert rows(quality.unknown_categories(df, "c", "n", ["a"])) == [(None, 1, None), ("b", 2, 5)]


@pytest.mark.parametrize("value", ["5.0", "5.5", "x", "", None])
def test_the_check_passes_what_the_load_takes(spark, value):
    df = spark.createDataFrame(
        [("2016-04-01", value, 4, 2016, 13, 6)],
        "date string, day string, month int, year int, weekofyear int, dayofweek int",
    )
    report = {r["column"]: r["passed"] for r in quality.schema_conformance(df, contracts.DATE).collect()}
    try:
        contracts.conform(df, contracts.DATE).collect()
        loads = True
    except Exception:
        loads = False
    assert report["day"] == loads == (value in ("5.0", None))


def test_schema_conformance_reports_missing_columns(spark):
    df = spark.createDataFrame(
        [("2016-04-01", 1, "4", "x")], "date string, day int, month string, year string"
    )
    got = {r["column"]: r for r in quality.schema_conformance(df, contracts.DATE).collect()}
    assert len(got) == 6
    assert got["day"].passed and got["month"].passed and got["month"].actual_type == "string"
    assert not got["year"].passed and got["year"].failed == 1
    assert not got["dayofweek"].passed and got["dayofweek"].actual_type is None


def test_orphans_exempt_null(spark, rows):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "c int")
    dim = spark.createDataFrame([(2,), (3,)], "Code int")
    assert rows(quality.orphans(fact, "c", dim, "Code")) == [(1, 2)]


def test_source_target_counts_show_groups_of_one_side(spark, rows):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "m int")
    b = spark.createDataFrame([(1,), (1,), (3,), (None,)], "m int")
    assert rows(quality.source_target_counts(a, b, ["m"])) == [
        (1, 2, 2, True),
        (2, 1, 0, False),
        (3, 0, 1, False),
        (None, 1, 1, True),
    ]
    assert rows(quality.source_target_counts(a, b)) == [(4, 4, True)]


def test_check_star_finds_each_fault(spark):
    fact_columns = {f.name: F.lit(None).cast(f.dataType) for f in contracts.IMMIGRATION.schema}

    def fact(cicid, cit, addr, arr):
        return spark.range(1).select(
            *[
                F.lit({"cicid": cicid, "i94cit": cit, "i94addr": addr, "arrdate": arr}.get(n))
                .cast(contracts.IMMIGRATION.schema[n].dataType)
                .alias(n)
                for n in fact_columns
            ]
        )

    visits = (
        fact(1, 10, "OR", "2016-04-01")
        .unionByName(fact(1, 11, "OR", "2016-04-02"))
        .unionByName(fact(None, 11, "XX", None))
    )
    tables = {
        "immigration": visits,
        "country": spark.createDataFrame([(10, "x"), (10, "y")], "Code int, Country string"),
        "state": spark.createDataFrame([("OR",)], "Code string"),
        "date": spark.createDataFrame([("2016-04-01",)], "date string"),
    }
    report = quality.check_star(tables, contracts.STAR).collect()
    got = {(r["table"], r["check"]): r.observed for r in report}
    assert got[("immigration", "non_empty")] == 3
    assert got[("immigration", "not_null")] == 1
    assert got[("immigration", "unique_key")] == 1
    assert got[("country", "unique_key")] == 1
    assert got[("immigration", "references_country:i94cit")] == 2
    assert got[("immigration", "references_country:i94res")] == 0
    assert got[("immigration", "references_state:i94addr")] == 1
    assert got[("immigration", "references_date:arrdate")] == 1
    assert len(got) == 4 * 3 + 5
