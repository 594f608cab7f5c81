"""Reading and writing files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmart.functions import int_from_text


def _columns(columns: str | Sequence[str]) -> list[str]:
    names = [columns] if isinstance(columns, str) else list(columns)
    return [c if c == "*" else f"`{c}`" for c in names]


def read_source(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    columns: str | Sequence[str] = "*",
    limit: int | None = None,
    schema=None,
    **options,
) -> DataFrame:
    """Load a source in any format the session knows, prune it, optionally limit it.

    CSV takes its names from the header and keeps every column as text: types are
    imposed later, and no pass over the data is spent on inferring them. ``limit`` is
    for trial runs and returns arbitrary rows.
    """
    if fmt == "csv":
        options = {"header": True, "inferSchema": False, **options}
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path).select(*_columns(columns))
    return df if limit is None else df.limit(limit)


def read_lookup(
    spark: SparkSession, path: str, int_code: str | None = None, **options
) -> DataFrame:
    """A code table from a headed CSV; ``int_code`` names a code column held as int."""
    df = read_source(spark, path, **options)
    return df if int_code is None else df.withColumn(int_code, int_from_text(int_code))


def _files(spark: SparkSession, path: str):
    """The path and its file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, files = _files(spark, path)
    return files.exists(place)


class Tally:
    """Counts over a DataFrame's rows, taken while something else reads them.

    ``rows`` is to be written in place of ``df``; ``result`` is there after that. Where execution
    finds the rows that are written to be none, it drops the counting with the rest of the plan,
    and they are counted on their own.
    """

    def __init__(self, df: DataFrame, counts: Mapping[str, Column]) -> None:
        self._df, self._seen = df, Observation()
        self._counts = [c.alias(name) for name, c in counts.items()]
        self.rows = df.observe(self._seen, *self._counts) if self._counts else df

    @cached_property
    def result(self) -> dict[str, int]:
        if not self._counts:
            return {}
        try:
            return dict(self._seen.get)
        except Py4JError:
            return self._df.agg(*self._counts).first().asDict()


def save(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    columns: str | Sequence[str] = "*",
    partition_by: Sequence[str] | None = None,
    rebalance: bool = True,
    **options,
) -> None:
    """Write a DataFrame, partitioned on disk if asked.

    For a partitioned write the rows are first rebalanced on the partition columns:
    small partitions then get one file rather than one per task, and adaptive execution
    splits a partition that holds an outsized share over several tasks. Turn
    ``rebalance`` off where the input already arrives one partition at a time; the
    shuffle then buys nothing.
    """
    out = df.select(*_columns(columns))
    if partition_by and rebalance:
        out = out.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by])
    writer = out.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def land(
    spark: SparkSession,
    input_path: str,
    output_path: str | None,
    partition_by: Sequence[str] | None = None,
    fmt: str = "csv",
    columns: str | Sequence[str] = "*",
    limit: int | None = None,
    **options,
) -> DataFrame:
    """Bring a raw source into partitioned Parquet unchanged; returns what was read."""
    df = read_source(spark, input_path, fmt, columns, limit, **options)
    if output_path is not None:
        save(df, output_path, partition_by=partition_by)
    return df
