from pyspark.sql import functions as F

from starmart.operators import joins, shape


def test_cast_columns_skips_missing_and_nulls_misfits(spark):
    df = spark.createDataFrame([("4.0", "x", "1.5")], "a string, b string, c string")
    out = shape.cast_columns(df, {"a": "int", "b": "int", "c": "double", "zz": "int"})
    assert out.dtypes == [("a", "int"), ("b", "int"), ("c", "double")]
    assert tuple(out.first()) == (4, None, 1.5)


def test_drop_and_rename_ignore_missing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert shape.drop_columns(df, ["b", "zz"]).columns == ["a"]
    assert shape.rename_columns(df, {"a": "x", "zz": "y"}).columns == ["x", "b"]


def test_overrides_apply_in_order_and_only_to_exact_values(spark, rows):
    df = spark.createDataFrame([("A",), ("B",), ("C",), ("a",), (None,)], "v string")
    changes = [("v", "A", "B"), ("v", "B", "C"), ("v", "A", "never")]
    assert rows(shape.override_values(df, changes)) == [("C",), ("C",), ("C",), (None,), ("a",)]


def test_overrides_equal_stepwise_replacement(spark, rows):
    values = ["p", "q", "r", "s", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    changes = [("v", "p", "q"), ("v", "r", "p"), ("v", "q", "s"), ("v", "s", "p"), ("v", "p", "r")]
    want = []
    for v in values:
        for _, old, new in changes:
            v = new if v == old else v
        want.append((v,))
    assert rows(shape.override_values(df, changes)) == sorted(want, key=lambda r: [str(r[0])])


def test_name_or_title(spark, rows):
    df = spark.createDataFrame([("Here", "X"), (None, "NEW YORK")], "a string, b string")
    assert rows(df.select(shape.name_or_title("a", "b"))) == [("Here",), ("New York",)]


def test_fill_zero_leaves_other_columns(spark):
    df = spark.createDataFrame([(None, None)], "a int, b int")
    assert tuple(shape.fill_zero(df, ["a"]).first()) == (0, None)


def test_decode_broadcasts_only_what_is_proven_small(spark, rows, plan):
    fact = spark.createDataFrame([(1, 1), (2, 9), (3, 4), (4, None)], "id int, mode int")
    modes = spark.createDataFrame(list(joins.MODES.items()), "ID int, Mode string")
    small = joins.decode(fact, modes, "mode", "ID", "Mode", "name")
    want = [(1, 1, "Air"), (2, 9, "Not reported"), (3, 4, None), (4, None, None)]
    assert rows(small) == want
    assert rows(joins.decode_fixed(fact, joins.MODES, "mode", "name")) == want
    assert "BroadcastHashJoin" in plan(small)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = joins.decode(fact, modes, "mode", "ID", "Mode", "name", max_rows=2)
        assert rows(large) == want
        assert "Broadcast" not in plan(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fits_broadcast_bounds_rows_and_bytes(spark):
    df = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert joins.fits_broadcast(df)
    assert not joins.fits_broadcast(df, max_rows=99)
    assert not joins.fits_broadcast(df, max_bytes=99_000)
    assert joins.fits_broadcast(df.limit(0))


def test_joins_on_text_and_shared_keys(spark, rows):
    left = spark.createDataFrame([("CONGO",), ("PERU",)], "a string")
    right = spark.createDataFrame([("Congo", 1)], "b string, n int")
    joined = joins.left_join_lower(left, right, "a", "b")
    assert rows(joined) == [("CONGO", "Congo", 1), ("PERU", None, None)]

    one = spark.createDataFrame([(1, None, 5), (1, 2, 6)], "k int, l int, x int")
    two = spark.createDataFrame([(1, None, 7), (1, 2, 8)], "k int, l int, y int")
    assert rows(joins.inner_join_keys(one, two, ["k", "l"])) == [(1, 2, 6, 8)]
