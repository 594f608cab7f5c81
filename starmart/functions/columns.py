"""Column expressions, all made of Spark built-ins.

They stay inside generated code, but for ``title_case``, whose ``transform`` does not: it is meant
for code tables, not for the fact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SAS_EPOCH = "1960-01-01"
DATE_PATTERN = "yyyy-MM-dd"
DATE_PARTS = ("year", "month", "day", "weekofyear", "dayofweek")

# A run of cased letters, or a run of anything else. Letters without case (such as
# ideographs) end a word, as they do in Python's str.title().
_CASED_RUNS = r"([\p{IsUppercase}\p{IsLowercase}\p{Lt}]+|[^\p{IsUppercase}\p{IsLowercase}\p{Lt}]+)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def double_from_text(c: Column | str) -> Column:
    """Text or number to double; what does not parse becomes NULL."""
    return _col(c).try_cast("double")


def int_from_text(c: Column | str) -> Column:
    """Text or number to int by way of double, so ``'4.0'`` is 4; otherwise NULL."""
    return double_from_text(c).try_cast("int")


def sas_date(days: Column | str) -> Column:
    """Days since 1960-01-01 (int, double or text) to a date."""
    return F.date_add(F.lit(SAS_EPOCH).cast("date"), int_from_text(days))


def date_from_text(c: Column | str, pattern: str = DATE_PATTERN) -> Column:
    """Text to date; a value that does not match the pattern becomes NULL."""
    return F.try_to_date(_col(c), pattern)


def stay_days(arrival: Column | str, departure: Column | str) -> Column:
    """Whole days from arrival to departure; may be negative, NULL if either is NULL."""
    return F.datediff(_col(departure), _col(arrival))


def date_parts(c: Column | str) -> dict[str, Column]:
    """Calendar attributes of a date: ISO week, and weekdays from 1 = Sunday."""
    c = _col(c)
    return {
        "year": F.year(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "weekofyear": F.weekofyear(c),
        "dayofweek": F.dayofweek(c),
    }


def title_case(c: Column | str, normalize_space: bool = False) -> Column:
    """Capital after every character that is not a cased letter, lower case elsewhere.

    ``initcap`` alone only starts words at blanks. ``normalize_space`` turns no-break
    spaces into plain ones first.
    """
    c = _col(c)
    if normalize_space:
        c = F.replace(c, F.lit("\u00a0"), F.lit(" "))
    runs = F.regexp_extract_all(c, F.lit(_CASED_RUNS), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")
