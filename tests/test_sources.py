import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starmart import contracts
from starmart.session import scratch_dir
from starmart.sources import (
    land_checked,
    land,
    load_table,
    read_lookup,
    read_source,
    save,
    upsert_partitions,
)


@pytest.fixture
def visits(spark):
    """Three months, one of which holds most of the rows."""
    return spark.range(4000).select(
        F.col("id").cast("int").alias("cicid"),
        F.lit(2016).alias("i94yr"),
        F.when(F.col("id") % 10 < 8, 4).otherwise(F.col("id") % 2 + 5).cast("int").alias("i94mon"),
        F.lit("first").alias("batch"),
    )


def test_csv_columns_stay_text_and_quotes_hold_commas(spark, tmp_path, rows):
    path = tmp_path / "port.csv"
    path.write_text('ID,Port\n001,"ANCHORAGE, AK"\n002,\n')
    df = read_source(spark, str(path))
    assert df.dtypes == [("ID", "string"), ("Port", "string")]
    assert rows(df) == [("001", "ANCHORAGE, AK"), ("002", None)]
    assert rows(read_source(spark, str(path), columns=["ID"], limit=1)) == [("001",)]
    assert rows(read_lookup(spark, str(path), int_code="ID"), "ID") == [(1,), (2,)]


def test_custom_delimiter_and_column_names_with_spaces(spark, tmp_path, rows):
    path = tmp_path / "cities.csv"
    path.write_text("City;State Code\nSalem;OR\n")
    assert rows(read_source(spark, str(path), columns=["State Code"], sep=";")) == [("OR",)]


def test_partitioned_write_splits_a_hot_partition(spark, visits, tmp_path):
    out = tmp_path / "visits"
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "8k")
    try:
        wide = visits.repartition(4).withColumn("pad", F.sha2(F.col("cicid").cast("string"), 512))
        save(wide, str(out), partition_by=["i94yr", "i94mon"])
    finally:
        spark.conf.unset(size)
    files = {p: len(list(p.glob("*.parquet"))) for p in out.glob("i94yr=*/i94mon=*")}
    hot = files.pop(out / "i94yr=2016" / "i94mon=4")
    assert len(files) == 2 and hot > 1
    assert spark.read.parquet(str(out)).count() == 4000


def test_small_partitions_get_one_file(spark, visits, tmp_path):
    save(visits.repartition(4), str(tmp_path / "v"), partition_by=["i94mon"])
    files = [len(list(p.glob("*.parquet"))) for p in (tmp_path / "v").glob("i94mon=*")]
    assert files == [1, 1, 1]


def test_month_filter_reads_one_partition(spark, visits, tmp_path, plan):
    save(visits, str(tmp_path / "v"), partition_by=["i94yr", "i94mon"])
    april = spark.read.parquet(str(tmp_path / "v")).where("i94mon = 4")
    april.collect()
    assert "PartitionFilters: [isnotnull(i94mon" in plan(april)


def test_month_refresh_is_idempotent_and_leaves_other_months(spark, visits, tmp_path, rows):
    path = str(tmp_path / "v")
    upsert_partitions(visits, path, [(2016, 4), (2016, 5), (2016, 6)])
    again = visits.where("i94mon = 5").withColumn("batch", F.lit("second"))
    seen = []
    for _ in range(2):
        assert upsert_partitions(again, path, [(2016, 5)], rebalance=False) == 0
        stored = spark.read.parquet(path)
        assert stored.count() == 4000
        seen.append(rows(stored.groupBy("i94mon", "batch").count()))
    assert seen[0] == seen[1]
    assert {(m, b) for m, b, _ in seen[0]} == {(4, "first"), (5, "second"), (6, "first")}


def test_month_refresh_never_touches_other_months(spark, visits, tmp_path, rows):
    """A stray row of another month, and one of none, are rejected and replace nothing."""
    path, rejects = str(tmp_path / "v"), str(tmp_path / "rejects")
    undated = visits.limit(2).withColumn("i94mon", F.lit(None).cast("int"))
    save(visits.unionByName(undated), path, partition_by=["i94yr", "i94mon"])
    may = visits.where("i94mon = 5").withColumn("batch", F.lit("second"))
    stray = visits.where("i94mon = 4").limit(1).withColumn("batch", F.lit("stray"))
    delivery = may.unionByName(stray).unionByName(undated.limit(1))
    with pytest.raises(ValueError, match="2 rows lie outside"):
        upsert_partitions(delivery, path, [(2016, 5)])
    before = rows(spark.read.parquet(path).groupBy("i94mon").count())
    assert upsert_partitions(delivery, path, [(2016, 5), (2016, 9)], rejects=rejects) == 2
    stored = spark.read.parquet(path)
    assert rows(stored.groupBy("i94mon").count()) == before
    assert {r["batch"] for r in stored.where("i94mon = 5").collect()} == {"second"}
    assert rows(spark.read.parquet(rejects), "i94mon") == [(4,), (None,)]


def test_land_keeps_rows_and_uses_the_partition_columns(spark, tmp_path, rows):
    path = tmp_path / "temp.csv"
    path.write_text("dt,City,Country\n1900,Lima,Peru\n1901,Lima,Peru\n1900,Oslo,Norway\n")
    out = tmp_path / "landed"
    landed = land(spark, str(path), str(out), ["Country", "City"])
    assert (out / "Country=Peru" / "City=Lima").is_dir()
    assert rows(spark.read.parquet(str(out)), "City", "dt") == rows(landed, "City", "dt")
    assert land(spark, str(path), None).count() == 3


def test_load_maps_by_name_and_appends(spark, rows):
    day = dt.date(2016, 4, 1)
    dates = spark.createDataFrame(
        [(day, 2016, 4, 1, 13, 6)],
        "date date, year int, month int, day int, weekofyear int, dayofweek int",
    )
    for _ in range(2):
        load_table(dates, contracts.DATE, "loaded_date")
    table = spark.table("loaded_date")
    assert table.columns == [f.name for f in contracts.DATE.schema]
    assert rows(table) == [("2016-04-01", 1, 4, 2016, 13, 6)] * 2
    with pytest.raises(ValueError, match="weekofyear"):
        load_table(dates.drop("weekofyear"), contracts.DATE, "never")


def test_a_value_that_does_not_fit_stops_the_load_or_is_put_aside(spark, tmp_path, rows):
    contract = contracts.DATE
    good = ("2016-04-01", "1.0", 4, 2016, 13, 6)
    bad = [("2016-4-1", "1", 4, 2016, 13, 6), ("2016-04-02", "1.5", 4, 2016, 13, 6)]
    names = "date string, day string, month int, year int, weekofyear int, dayofweek int"
    df = spark.createDataFrame([good, *bad], names)
    with pytest.raises(Exception, match="cannot take"):
        load_table(df, contract, "refused")
    load_table(df, contract, "sifted", rejects=str(tmp_path / "r"))
    assert rows(spark.table("sifted")) == [("2016-04-01", 1, 4, 2016, 13, 6)]
    assert spark.read.parquet(str(tmp_path / "r" / "misfits")).count() == 2
    days = spark.createDataFrame([(20551.0, 1, 4, 2016, 13, 6)], names.replace("date string", "date double").replace("day string", "day int"))
    with pytest.raises(Exception, match="cannot take"):
        load_table(days, contract, "refused")


def test_a_standing_table_is_overwritten_in_place(spark):
    names = "date string, day int, month int, year int, weekofyear int, dayofweek int"
    for day in (1, 2):
        df = spark.createDataFrame([(f"2016-04-0{day}", day, 4, 2016, 13, 6)], names)
        load_table(df, contracts.DATE, "standing", "overwrite")
        made = spark.sql("DESCRIBE TABLE EXTENDED standing").where("col_name = 'Created Time'").first()
        assert [r["day"] for r in spark.table("standing").collect()] == [day]
        assert day == 1 or made == first
        first = made


def test_table_refresh_replaces_only_delivered_months(spark, visits, rows):
    contract = contracts.TableContract("visits", visits.schema, ("cicid",))
    months = ["i94yr", "i94mon"]
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    every = [(2016, 4), (2016, 5), (2016, 6)]
    load_table(visits, contract, "monthly", "refresh", partition_by=months, partitions=every)
    again = visits.where("i94mon = 5").withColumn("batch", F.lit("second"))
    for _ in range(2):
        load_table(
            again, contract, "monthly", "refresh", partition_by=months, partitions=[(2016, 5)]
        )
        got = rows(spark.table("monthly").groupBy("i94mon", "batch").count())
        assert {(m, b) for m, b, _ in got} == {(4, "first"), (5, "second"), (6, "first")}
        assert sum(n for *_, n in got) == 4000
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    with pytest.raises(ValueError, match="partition columns"):
        load_table(visits, contract, "monthly", "refresh")
    with pytest.raises(ValueError, match="delivered partitions"):
        load_table(visits, contract, "monthly", "refresh", partition_by=months)
    with pytest.raises(ValueError, match="outside the refresh"):
        load_table(
            visits, contract, "monthly", "refresh", partition_by=months, partitions=[(2016, 5)]
        )
    again.write.partitionBy(*months).saveAsTable("monthly_plain")
    with pytest.raises(ValueError, match="replaced whole"):
        load_table(
            again, contract, "monthly_plain", "refresh", partition_by=months, partitions=[(2016, 5)]
        )


def test_scratch_lies_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two and Path(one).parent.parent == Path(base)
    assert Path(one).parent.name == f"starmart-{spark.sparkContext.applicationId}"


def test_a_failed_first_load_is_followed_by_a_good_one(spark, tmp_path, rows):
    """Of the failed load no row is left, nor anything that stands in the way of the next."""
    names = "date string, day string, month int, year int, weekofyear int, dayofweek int"
    good = spark.createDataFrame([("2016-04-01", "1", 4, 2016, 13, 6)], names)
    bad = good.unionByName(good.withColumn("day", F.lit("1.5"))).repartition(2)
    for _ in range(2):
        with pytest.raises(Exception, match="cannot take"):
            load_table(bad, contracts.DATE, "first_load")
        assert spark.table("first_load").count() == 0
    load_table(good, contracts.DATE, "first_load")
    assert rows(spark.table("first_load")) == [("2016-04-01", 1, 4, 2016, 13, 6)]


def test_rejects_are_kept_by_delivery(spark, visits, tmp_path, rows):
    path, rejects = str(tmp_path / "v"), str(tmp_path / "rejects")
    save(visits, path, partition_by=["i94yr", "i94mon"])
    april, may = visits.where("i94mon = 4").limit(3), visits.where("i94mon = 5")
    for name, strays in (("one", 3), ("two", 2), ("two", 2)):
        assert upsert_partitions(may.unionByName(april.limit(strays)), path, [(2016, 5)], rejects=rejects, delivery=name) == strays
    kept = spark.read.parquet(rejects)
    assert rows(kept.groupBy("delivery").count()) == [("one", 3), ("two", 2)]
    assert upsert_partitions(may, path, [(2016, 5)], rejects=rejects, delivery="three") == 0
    assert upsert_partitions(may.unionByName(april), path, [(2016, 5)], rejects=rejects) == 3
    assert spark.read.parquet(rejects).count() == 8 and spark.read.parquet(path).count() == 4000


def test_a_delivery_is_read_once(spark, visits, tmp_path):
    """The source is parsed again only for rows that were rejected."""
    path = str(tmp_path / "v")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    save(visits, path, partition_by=["i94yr", "i94mon"])
    may = visits.where("i94mon = 5")
    n = may.count()
    delivery = may.mapInArrow(counted, may.schema)
    assert upsert_partitions(delivery, path, [(2016, 5)], rejects=str(tmp_path / "r"), rebalance=False) == 0
    assert seen.value == n


CSV = """a;b;"c d"
1;2;3
1;2
1;2;3;4

x;"q;r";y
"x;2;3
a;b;c d
;;
1;2;"3
"""


@pytest.mark.parametrize("sep", [";", ","])
def test_every_line_is_landed_or_rejected(spark, tmp_path, rows, sep):
    (tmp_path / "in").mkdir()
    for name in ("one", "two"):
        (tmp_path / "in" / name).write_text(CSV.replace(";", sep))
    out, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    report = land_checked(spark, str(tmp_path / "in"), out, rejects, sep=sep)
    assert [tuple(r) for r in report.collect()] == [(14, 6, 8, True)]
    landed = rows(spark.read.parquet(out))
    assert landed == sorted([("1", "2", "3"), ("x", f"q{sep}r", "y"), (None, None, None)] * 2, key=lambda r: [str(v) for v in r])
    bad = rows(spark.read.parquet(rejects))
    lines = {("1;2", "fields"), ("1;2;3;4", "fields"), ('"x;2;3', "quote"), ('1;2;"3', "quote")}
    assert set(bad) == {(line.replace(";", sep), why) for line, why in lines} and len(bad) == 8


def test_a_checked_source_without_bad_lines_or_rows(spark, tmp_path):
    (tmp_path / "fine.csv").write_text("a,b\n1,2\n")
    (tmp_path / "none.csv").write_text("a,b\n")
    for name, n in (("fine", 1), ("none", 0)):
        out = [str(tmp_path / f"{name}-{x}") for x in ("out", "bad")]
        assert tuple(land_checked(spark, str(tmp_path / f"{name}.csv"), *out).first()) == (n, n, 0, True)
        assert spark.read.parquet(out[1]).columns == ["line", "reason"]


def test_text_numbers_are_parsed_once(spark):
    schema = contracts.IMMIGRATION.schema
    row = ["4.0" if f.dataType.simpleString() == "int" else "2016-04-01" for f in schema]
    texts = spark.createDataFrame([row], ", ".join(f"`{f.name}` string" for f in schema))
    loaded = contracts.conform(texts, contracts.IMMIGRATION)
    assert loaded.first()["cicid"] == 4
    plan = loaded._jdf.queryExecution().optimizedPlan().toString()
    loaded_plan = [line for line in plan.split("\n") if "Project" in line]
    # The outermost step refers to values and holds no parsing of its own.
    assert len(loaded_plan) > 1 and "try_cast" not in loaded_plan[0]


def test_text_numbers_keep_their_digits(spark):
    schema = contracts.STATE.schema
    cases = {"9007199254740993": 9007199254740993, " 7 ": 7, "7.0": 7, "-9223372036854775808": -(2**63), "1e3": 1000, None: None}
    rows = [["x"] * 2 + [t] * 10 for t in cases]
    texts = spark.createDataFrame(rows, ", ".join(f"`{f.name}` string" for f in schema))
    got = [r["White"] for r in contracts.conform(texts, contracts.STATE).collect()]
    assert sorted(got, key=str) == sorted(cases.values(), key=str)
    for bad in ("1.5", "four"):
        with pytest.raises(Exception, match="cannot take"):
            contracts.conform(texts.limit(1).withColumn("White", F.lit(bad)), contracts.STATE).collect()


def test_months_name_each_year_once(spark):
    from starmart.sources.tables import in_partitions

    months = [(y, m) for y in range(1992, 1999) for m in range(1, 13) if (y, m) != (1995, 6)]
    column = in_partitions(months)
    assert str(column).count("i94yr") == 7
    rows = spark.createDataFrame([(1995, 6), (1995, 7), (None, 7), (1995, None), (2000, 7)], "i94yr int, i94mon int")
    assert [tuple(r) for r in rows.where(column).collect()] == [(1995, 7)]
    assert rows.where(in_partitions([])).isEmpty() and rows.where(in_partitions([(1995, None)])).isEmpty()
