"""Joins: code decoding, normalised text keys, shared keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 10_000
BROADCAST_BYTES = 8 * 1024 * 1024

# Codes of the mode of transportation and of the visa category, for callers that
# have no code tables to read.
MODES = {1: "Air", 2: "Sea", 3: "Land", 9: "Not reported"}
VISAS = {1: "Business", 2: "Pleasure", 3: "Student"}


def decode_fixed(df: DataFrame, codes: Mapping[int, str], key: str, output: str) -> DataFrame:
    """Add ``output``: the text of a code from a handful of fixed ones, else NULL.

    Codes outside the handful become NULL; where there is a code table, use ``decode``.
    """
    entries = [F.lit(x) for code, text in codes.items() for x in (code, text)]
    return df.withColumn(output, F.try_element_at(F.create_map(*entries), F.col(f"`{key}`")))


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether a DataFrame is proven small, by counting its rows and bytes in one pass."""
    return fit_broadcast([df], max_rows, max_bytes)[0]


def fit_broadcast(
    dfs: Sequence[DataFrame], max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> list[bool]:
    """Whether each of some DataFrames is proven small, by one job that counts rows and bytes of all.

    Each task sends one row of totals, so asking this of a large DataFrame is cheap next to
    the join it decides on.
    """
    probes = []
    for i, df in enumerate(dfs):
        width = sum(
            (F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns),
            F.lit(0),
        )
        totals = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("size"))
        probes.append(totals.withColumn("at", F.lit(i)))
    found = {r["at"]: r for r in reduce(DataFrame.unionByName, probes).collect()}
    return [found[i]["n"] <= max_rows and found[i]["size"] <= max_bytes for i in range(len(dfs))]


def _code_side(lookup: DataFrame, code: str, value: str, output: str) -> DataFrame:
    return (
        lookup.where(F.col(f"`{code}`").isNotNull())
        .groupBy(F.col(f"`{code}`").alias("__code"))
        .agg(F.min(F.col(f"`{value}`")).alias(output))
    )


def decode_all(
    df: DataFrame,
    lookups: Sequence[tuple[DataFrame, str, str, str, str]],
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``decode`` by several code tables, each (lookup, key, code, value, output), measured in one job."""
    sides = [_code_side(lookup, code, value, output) for lookup, _, code, value, output in lookups]
    for (_, key, *_), side, small in zip(lookups, sides, fit_broadcast(sides, max_rows), strict=True):
        side = F.broadcast(side) if small else side
        df = df.join(side, F.col(f"`{key}`") == F.col("__code"), "left").drop("__code")
    return df


def decode(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    code: str,
    value: str,
    output: str,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add ``output``: the lookup's value for the row's code, NULL where there is none.

    A code listed more than once takes its least value, so rows never multiply; the quality
    check ``duplicate_keys`` on the lookup reports such codes. A lookup proven small is broadcast
    and the rows are not shuffled. A larger one is joined by shuffle, where adaptive execution
    splits hot codes.
    """
    return decode_all(df, [(lookup, key, code, value, output)], max_rows)


def left_join_lower(
    left: DataFrame, right: DataFrame, left_name: str, right_name: str
) -> DataFrame:
    """Left join of two text columns that may differ in case."""
    return left.join(
        right, F.lower(left[f"`{left_name}`"]) == F.lower(right[f"`{right_name}`"]), "left"
    )


def inner_join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on shared keys, each kept once; a NULL in any key matches nothing."""
    return left.join(right, list(keys), "inner")
