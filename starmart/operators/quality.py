"""Quality checks. Each returns a DataFrame, so a report can be stored or asserted on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.contracts import TableContract, fitted
from starmart.functions import double_from_text, int_from_text
from starmart.operators.shape import cast_columns

CHECK_COLUMNS = ("table", "check", "observed", "passed")


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _per_column(
    totals: DataFrame, entries: Sequence[Sequence[Column]], names: Sequence[str]
) -> DataFrame:
    """One aggregated row to one row per entry."""
    rows = [F.struct(*[c.alias(n) for c, n in zip(entry, names)]) for entry in entries]
    return totals.select(F.inline(F.array(*rows)))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows)."""
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
            for name, df in tables.items()
        ]
    )


def non_empty(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, check, observed, passed): every table holds at least one row."""
    return row_counts(tables).select(
        "table",
        F.lit("non_empty").alias("check"),
        F.col("rows").alias("observed"),
        (F.col("rows") > 0).alias("passed"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return (
        df.groupBy(*[_col(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > 1)
    )


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: rows, distinct rows, and the surplus, over the given or all columns."""
    groups = df.groupBy(*[_col(c) for c in columns or df.columns]).agg(
        F.count(F.lit(1)).alias("n")
    )
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, rows, nulls, null_ratio) for all columns, from one pass."""
    names = list(columns or df.columns)
    totals = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(_col(c).isNull()).alias(f"n{i}") for i, c in enumerate(names)],
    )
    entries = [
        (F.lit(c), F.col("rows"), F.col(f"n{i}"), F.try_divide(F.col(f"n{i}"), F.col("rows")))
        for i, c in enumerate(names)
    ]
    return _per_column(totals, entries, ("column", "rows", "nulls", "null_ratio"))


def null_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, nulls) for columns that must be filled."""
    return null_profile(df, columns).select("column", "nulls")


def drop_high_null(df: DataFrame, threshold: float, profile: DataFrame | None = None) -> DataFrame:
    """Drop the columns whose NULL ratio exceeds the threshold.

    The profile holds one row per column, so reading it on the driver is bounded.
    """
    report = profile if profile is not None else null_profile(df)
    high = [r["column"] for r in report.where(F.col("null_ratio") > threshold).collect()]
    return df.drop(*high)


def cast_failures(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """(column, target_type, rows, failed): filled values that do not fit the target type.

    A fraction that an int would lose counts as a failure, although the cast truncates it.
    """
    present = {c: t for c, t in types.items() if c in df.columns}
    cast = cast_columns(
        df.select(*[_col(c) for c in present], *[_col(c).alias(f"raw {c}") for c in present]),
        present,
    )

    def failed(c: str, target: str) -> Column:
        raw, value = _col(f"raw {c}"), _col(c)
        lost = value.isNull()
        if target in ("int", "bigint"):
            lost |= F.coalesce(double_from_text(raw) != value.cast("double"), F.lit(False))
        return raw.isNotNull() & lost

    totals = cast.agg(
        *[F.count(_col(f"raw {c}")).alias(f"r{i}") for i, c in enumerate(present)],
        *[F.count_if(failed(c, t)).alias(f"f{i}") for i, (c, t) in enumerate(present.items())],
    )
    entries = [
        (F.lit(c), F.lit(t), F.col(f"r{i}"), F.col(f"f{i}"))
        for i, (c, t) in enumerate(present.items())
    ]
    return _per_column(totals, entries, ("column", "target_type", "rows", "failed"))


def schema_conformance(df: DataFrame, contract: TableContract) -> DataFrame:
    """Per contract column: expected and actual type, and how many values do not fit.

    A missing column has no actual type and does not pass. A type that differs passes as
    long as every value converts, by the very cast that the load makes.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    expected = {
        f.name: "date text" if f.name in contract.date_text else f.dataType.simpleString()
        for f in contract.schema
    }
    shared = [c for c in expected if c in actual]
    totals = df.agg(
        *[F.count_if(fitted(df, contract, c)[1]).alias(f"f{i}") for i, c in enumerate(shared)]
    )
    entries = [
        (F.lit(contract.name), F.lit(c), F.lit(expected[c]), F.lit(actual[c]), n, n == 0)
        for c, n in ((c, F.col(f"f{i}")) for i, c in enumerate(shared))
    ]
    names = ("table", "column", "expected_type", "actual_type", "failed", "passed")
    report = _per_column(totals, entries, names) if shared else None
    missing = [(contract.name, c, t) for c, t in expected.items() if c not in actual]
    if report is not None and not missing:
        return report
    absent = df.sparkSession.createDataFrame(
        missing, "table string, column string, expected_type string"
    ).select(
        "*",
        F.lit(None).cast("string").alias("actual_type"),
        F.lit(None).cast("long").alias("failed"),
        F.lit(False).alias("passed"),
    )
    return absent if report is None else report.unionByName(absent)


def unknown_categories(
    df: DataFrame, category: str, measure: str, known: Sequence[str]
) -> DataFrame:
    """(value, rows, total): categories that no column is made for, NULL among them.

    What a fixed list of columns leaves out is reported here.
    """
    listed = F.coalesce(_col(category).isin(*known), F.lit(False))
    return (
        df.where(~listed)
        .groupBy(_col(category).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(int_from_text(_col(measure))).alias("total"))
    )


def orphans(fact: DataFrame, foreign_key: str, dim: DataFrame, key: str) -> DataFrame:
    """(code, visits): filled codes of the fact that the dimension lacks.

    The fact is reduced to its distinct codes first; only those meet the dimension.
    """
    codes = (
        fact.where(_col(foreign_key).isNotNull())
        .groupBy(_col(foreign_key).alias("code"))
        .agg(F.count(F.lit(1)).alias("visits"))
    )
    known = dim.select(_col(key).alias("known"))
    return codes.join(known, F.col("code") == F.col("known"), "left_anti")


def source_target_counts(
    source: DataFrame, target: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Rows of source and target, in total or per group, and whether they agree.

    Groups that only one side has appear with 0 on the other.
    """
    keys = [_col(k) for k in by]

    def side(df: DataFrame, is_source: bool) -> DataFrame:
        n, zero = F.count(F.lit(1)), F.lit(0).cast("long")
        return df.groupBy(*keys).agg(n.alias("n")).select(
            *keys,
            (F.col("n") if is_source else zero).alias("source_rows"),
            (zero if is_source else F.col("n")).alias("target_rows"),
        )

    both = side(source, True).unionByName(side(target, False))
    return (
        both.groupBy(*keys)
        .agg(F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows"))
        .withColumn("complete", F.col("source_rows") == F.col("target_rows"))
    )


def _filled_and_keyed(name: str, df: DataFrame, contract: TableContract) -> DataFrame:
    """Rows, NULL keys and repeated keys of a table, all from its rows counted by key."""
    keys = contract.primary_key
    groups = df.groupBy(*[_col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.count_if(_col(c).isNull()).alias(f"null {c}")
            for c in contract.not_null
            if c not in keys
        ],
    )
    lost = [F.when(_col(k).isNull(), F.col("n")).otherwise(0) for k in keys]
    lost += [_col(f"null {c}") for c in contract.not_null if c not in keys]
    totals = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(reduce(lambda a, b: a + b, lost)), F.lit(0)).alias("nulls"),
        F.count_if(F.col("n") > 1).alias("dups"),
    )
    rows, nulls, dups = F.col("rows"), F.col("nulls"), F.col("dups")
    entries = [
        (F.lit(name), F.lit("non_empty"), rows, rows > 0),
        (F.lit(name), F.lit("not_null"), nulls, nulls == 0),
        (F.lit(name), F.lit("unique_key"), dups, dups == 0),
    ]
    return _per_column(totals, entries, CHECK_COLUMNS)


def _reference(
    name: str, df: DataFrame, column: str, other: str, dim: DataFrame, key: str
) -> DataFrame:
    """How many rows refer to nothing by one foreign key."""
    lost = orphans(df, column, dim, key).agg(F.coalesce(F.sum("visits"), F.lit(0)).alias("n"))
    n = F.col("n")
    entry = (F.lit(name), F.lit(f"references_{other}:{column}"), n, n == 0)
    return _per_column(lost, [entry], CHECK_COLUMNS)


def check_star(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, TableContract]
) -> DataFrame:
    """(table, check, observed, passed) for all tables: filled, unique, keyed, referenced.

    Meant for stored tables. Each foreign key reads its own column alone, which took half the
    time of unfolding all of them from a single pass.
    """
    parts = []
    for name, contract in contracts.items():
        df = tables[name]
        parts.append(_filled_and_keyed(name, df, contract))
        parts += [
            _reference(name, df, column, other, tables[other], key)
            for column, (other, key) in contract.foreign_keys.items()
        ]
    return _union(parts)


def assert_passed(report: DataFrame) -> None:
    """Raise if a check failed. A report has a row per table and check, never per record."""
    failed = report.where(~F.col("passed")).collect()
    if failed:
        lines = [f"{r['table']}: {r['check']} observed {r['observed']}" for r in failed]
        raise ValueError("data quality check failed: " + "; ".join(lines))
