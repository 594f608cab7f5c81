"""Cleaning steps: casts, renames, value overrides, fallbacks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from starmart.functions import double_from_text, int_from_text, title_case


def _cast(c: Column, target: str) -> Column:
    if target == "int":
        return int_from_text(c)
    if target == "double":
        return double_from_text(c)
    return c.try_cast(target)


def cast_columns(df: DataFrame, types: Mapping[str, DataType | str]) -> DataFrame:
    """Cast the named columns that exist; a value that does not fit becomes NULL."""
    present = set(df.columns)
    casts = {}
    for name, target in types.items():
        if name in present:
            target = target if isinstance(target, str) else target.simpleString()
            casts[name] = _cast(F.col(f"`{name}`"), target)
    return df.withColumns(casts) if casts else df


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns by name, passing over those that are not there."""
    return df.drop(*names)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns by mapping; the others keep their names and all keep their order."""
    return df.withColumnsRenamed(dict(mapping))


def _net_overrides(changes: Iterable[tuple[str, str, str]]) -> dict[str, dict[str, str]]:
    """What each old value ends up as once the changes have run one after the other."""
    net: dict[str, dict[str, str]] = {}
    for field, old, new in changes:
        values = net.setdefault(field, {})
        for source, result in values.items():
            if result == old:
                values[source] = new
        values.setdefault(old, new)
    return net


def override_values(df: DataFrame, changes: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Replace exact values, given as (field, old, new) and applied in order.

    Other values and NULL stay. The list is folded to its net effect first, which gives
    one flat CASE per field instead of one nested in the next.
    """
    columns = {}
    for field, values in _net_overrides(changes).items():
        current = F.col(f"`{field}`")
        chain = F
        for old, new in values.items():
            chain = chain.when(current == F.lit(old), F.lit(new))
        columns[field] = chain.otherwise(current)
    return df.withColumns(columns) if columns else df


def name_or_title(name: Column | str, fallback: Column | str, **options) -> Column:
    """The name, or the fallback in title case where the name is NULL."""
    name = F.col(name) if isinstance(name, str) else name
    return F.coalesce(name, title_case(fallback, **options))


def fill_zero(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """NULL to 0 in the named numeric columns."""
    return df.fillna(0, subset=list(names))
