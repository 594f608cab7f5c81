"""Aggregations shared by the dimensions and the analysis."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def category_sums(category: str, measure: str, categories: Mapping[str, str]) -> list[Column]:
    """One conditional sum per category value, named by the mapping."""
    cat, value = F.col(f"`{category}`"), F.col(f"`{measure}`")
    return [
        F.sum(F.when(cat == F.lit(label), value)).alias(name)
        for label, name in categories.items()
    ]


def pivot_sum(
    df: DataFrame,
    keys: Sequence[str],
    category: str,
    measure: str,
    categories: Mapping[str, str] | None = None,
) -> DataFrame:
    """Category values become columns holding the sum of the measure.

    With the values given, by the names their columns take, no job runs to find them and the
    schema is fixed. Without, every value that occurs becomes a column of its own name.
    """
    groups = df.groupBy(*_cols(keys))
    if categories is None:
        return groups.pivot(category).sum(measure)
    return groups.pivot(category, list(categories)).sum(measure).withColumnsRenamed(categories)


def sum_columns(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sums under the measures' own names."""
    return df.groupBy(*_cols(keys)).agg(
        *[F.sum(F.col(f"`{m}`")).alias(m) for m in measures]
    )


def distinct_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of several date columns as (role, date), from one scan."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("role"), F.col(f"`{c}`").alias("date")) for c in columns]
    )
    return df.select(F.inline(pairs)).distinct()


def date_union(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of each column, one list after the other, repeats kept."""
    return distinct_dates(df, columns).select("date")


def count_by(df: DataFrame, keys: Sequence[str], name: str = "visits") -> DataFrame:
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(name))
