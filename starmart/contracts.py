"""Target tables: types, keys and references of the star, and conforming to them."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from starmart.functions import date_from_text, double_from_text


@dataclass(frozen=True)
class TableContract:
    name: str
    schema: StructType
    primary_key: tuple[str, ...]
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)
    date_text: tuple[str, ...] = ()  # text columns that hold dates as YYYY-MM-DD

    @property
    def not_null(self) -> tuple[str, ...]:
        """Columns that must be filled: the key, plus fields declared so."""
        declared = [f.name for f in self.schema if not f.nullable]
        return tuple(dict.fromkeys([*self.primary_key, *declared]))


# Table layouts of the target warehouse, dates loaded as YYYY-MM-DD text.
IMMIGRATION = TableContract(
    name="immigration",
    schema=StructType(
        [
            StructField("i94mon", IntegerType()),
            StructField("cicid", IntegerType()),
            StructField("i94visa", IntegerType()),
            StructField("i94res", IntegerType()),
            StructField("i94yr", IntegerType()),
            StructField("i94mode", IntegerType()),
            StructField("i94cit", IntegerType()),
            StructField("i94bir", IntegerType()),
            StructField("stay", IntegerType()),
            StructField("arrdate", StringType()),
            StructField("depdate", StringType()),
            StructField("airline", StringType()),
            StructField("fltno", StringType()),
            StructField("i94port", StringType()),
            StructField("visatype", StringType()),
            StructField("gender", StringType()),
            StructField("i94addr", StringType()),
        ]
    ),
    primary_key=("cicid",),
    foreign_keys={
        "i94cit": ("country", "Code"),
        "i94res": ("country", "Code"),
        "arrdate": ("date", "date"),
        "depdate": ("date", "date"),
        "i94addr": ("state", "Code"),
    },
    date_text=("arrdate", "depdate"),
)

COUNTRY = TableContract(
    name="country",
    schema=StructType(
        [
            StructField("Code", IntegerType()),
            StructField("Country", StringType()),
            StructField("Temperature", DoubleType()),
            StructField("Latitude", StringType()),
            StructField("Longitude", StringType()),
        ]
    ),
    primary_key=("Code",),
)

STATE = TableContract(
    name="state",
    schema=StructType(
        [
            StructField("Code", StringType()),
            StructField("State", StringType()),
            StructField("BlackOrAfricanAmerican", LongType()),
            StructField("White", LongType()),
            StructField("ForeignBorn", LongType()),
            StructField("AmericanIndianAndAlaskaNative", LongType()),
            StructField("HispanicOrLatino", LongType()),
            StructField("Asian", LongType()),
            StructField("NumberVeterans", LongType()),
            StructField("FemalePopulation", LongType()),
            StructField("MalePopulation", LongType()),
            StructField("TotalPopulation", LongType()),
        ]
    ),
    primary_key=("Code",),
)

DATE = TableContract(
    name="date",
    schema=StructType(
        [
            StructField("date", StringType(), nullable=False),
            StructField("day", IntegerType()),
            StructField("month", IntegerType()),
            StructField("year", IntegerType()),
            StructField("weekofyear", IntegerType()),
            StructField("dayofweek", IntegerType()),
        ]
    ),
    primary_key=("date",),
    date_text=("date",),
)

STAR = {c.name: c for c in (IMMIGRATION, COUNTRY, STATE, DATE)}


def _is_whole(contract: TableContract, name: str) -> bool:
    whole = isinstance(contract.schema[name].dataType, (IntegerType, LongType))
    return whole and name not in contract.date_text


def _value(df: DataFrame, contract: TableContract, name: str, number: Column) -> Column:
    """A contract column's value as it is loaded; ``number`` is the column as a double."""
    column = F.col(f"`{name}`")
    target = contract.schema[name].dataType
    source = next(f.dataType for f in df.schema if f.name.lower() == name.lower())
    if name in contract.date_text:
        if isinstance(source, (DateType, TimestampType, TimestampNTZType)):
            return column.cast("date").cast("string")
        if isinstance(source, StringType):
            return date_from_text(column).cast("string")
        return F.lit(None).cast("string")
    if not _is_whole(contract, name):
        return column.try_cast(target)
    if not isinstance(source, StringType):
        return F.coalesce(column.try_cast(target), number.try_cast(target))
    # Text such as '4.0' is no int to Spark, which finds that out by an exception for each value.
    # A double has all whole numbers up to 2**53 exactly.
    exact = F.when(F.abs(number) < 2.0**53, number.try_cast(target))
    return F.coalesce(exact, column.try_cast(target), number.try_cast(target))


def _fraction(contract: TableContract, name: str, number: Column) -> Column:
    """Whether a number is not whole."""
    whole = number.try_cast(contract.schema[name].dataType)
    return F.coalesce(number != whole.cast("double"), F.lit(False))


def fitted(df: DataFrame, contract: TableContract, name: str) -> tuple[Column, Column]:
    """A contract column's value as it is loaded, and whether a filled value does not fit.

    The load and the checks both go by this. Numbers may come as text or in another numeric
    type, but not with a fraction where the contract has whole ones. Date text comes from a
    date, a timestamp or text of that very form, and not from numbers.
    """
    column = F.col(f"`{name}`")
    number = double_from_text(column)
    value = _value(df, contract, name, number)
    lost = value.isNull()
    if _is_whole(contract, name):
        lost = lost | _fraction(contract, name, number)
    return value, column.isNotNull() & lost


def _present(df: DataFrame, contract: TableContract) -> None:
    present = {c.lower() for c in df.columns}
    missing = [f.name for f in contract.schema if f.name.lower() not in present]
    if missing:
        raise ValueError(f"{contract.name}: columns missing from the data: {missing}")


def misfits(df: DataFrame, contract: TableContract) -> Column:
    """Whether a row holds a filled value that does not fit its column."""
    _present(df, contract)
    return reduce(or_, [fitted(df, contract, f.name)[1] for f in contract.schema])


def conform(df: DataFrame, contract: TableContract) -> DataFrame:
    """The contract's columns, matched by name, in its order and types.

    Matching is never by position: producers write their columns in another order. A filled
    value that does not fit stops the job that meets it.
    """
    _present(df, contract)
    names = [f.name for f in contract.schema]
    whole = [n for n in names if _is_whole(contract, n)]
    # Step by step: in a single expression a value's parsing stands wherever the value does, which
    # for a wide table is more code than the JVM takes.
    own = df.select(*[F.col(f"`{n}`").alias(n) for n in names])
    numbers = own.select("*", *[double_from_text(F.col(f"`{n}`")).alias(f"{n} number") for n in whole])
    number = {n: F.col(f"`{n} number`") for n in whole}
    values = numbers.select(
        *[F.col(f"`{n}`") for n in names],
        *[_value(own, contract, n, number.get(n)).alias(f"{n} value") for n in names],
        *[_fraction(contract, n, number[n]).alias(f"{n} fraction") for n in whole],
    )
    columns = []
    for f in contract.schema:
        column, value = F.col(f"`{f.name}`"), F.col(f"`{f.name} value`")
        lost = value.isNull()
        if f.name in number:
            lost = lost | F.col(f"`{f.name} fraction`")
        text = F.concat(F.lit(f"{contract.name}.{f.name} cannot take "), column.cast("string"))
        checked = F.when(column.isNotNull() & lost, F.raise_error(text).cast(f.dataType)).otherwise(value)
        columns.append(checked.alias(f.name))
    return values.select(*columns)
