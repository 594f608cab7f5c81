"""The visits fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from starmart.functions import sas_date, stay_days
from starmart.operators.shape import cast_columns, drop_columns

# Columns of the arrival records.
VISIT_COLUMNS = (
    "i94addr", "i94mon", "cicid", "i94visa", "i94res", "arrdate", "i94yr", "depdate",
    "airline", "fltno", "i94mode", "i94port", "visatype", "gender", "i94cit", "i94bir",
)
INT_COLUMNS = (
    "cicid", "i94yr", "i94mon", "i94cit", "i94res", "i94mode", "i94bir", "i94visa",
    "count", "biryear", "dtadfile",
)
DATE_COLUMNS = ("arrdate", "depdate")
HIGH_NULL_COLUMNS = ("visapost", "occup", "entdepu", "insnum")
NOT_USEFUL_COLUMNS = (
    "count", "entdepa", "entdepd", "matflag", "dtaddto", "biryear", "admnum",
)


def visits(raw: DataFrame, columns: Sequence[str] | None = VISIT_COLUMNS) -> DataFrame:
    """Arrival records conformed: integer codes, real dates, and the length of stay.

    ``columns`` selects what to read, ``None`` takes every column. Row by row, so the
    fact needs no shuffle.
    """
    picked = raw if columns is None else raw.select(*columns)
    picked = drop_columns(picked, (*HIGH_NULL_COLUMNS, *NOT_USEFUL_COLUMNS))
    typed = cast_columns(picked, dict.fromkeys(INT_COLUMNS, "int"))
    dates = {c: sas_date(c) for c in DATE_COLUMNS if c in typed.columns}
    dated = typed.withColumns(dates) if dates else typed
    if len(dates) < len(DATE_COLUMNS):
        return dated
    return dated.withColumn("stay", stay_days("arrdate", "depdate"))
