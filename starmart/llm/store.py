"""Tables that an operator writes and reads again, and what else the operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import scratch_dir
from starmart.sources.files import _files

# A word is a run of anything but these six characters.
SPACE = r"\x20\x09-\x0D"


# Shuffle files go with the action that made them, not when the driver next collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# The folders of tables written within ``passing``.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def written(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` as a table in the shared scratch folder: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.partitionBy(*partition_by).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    if (made := _MADE.get()) is not None:
        made.append(path)
    # A partitioned table without rows has no file to tell its columns.
    return (spark.read.schema(df.schema) if partition_by else spark.read).parquet(path)


# What goes to Python at once. The JVM keeps a batch outside of its heap, more than once while it is sent.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20
_ARROW = "spark.sql.execution.arrow.max{}PerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Sends texts to Python in batches of ``BATCH_ROWS`` at most, for the actions within."""
    rows, size = _ARROW.format("Records"), _ARROW.format("Bytes")
    before = {key: spark.conf.get(key) for key in (rows, size)}
    allowed = int(before[rows])
    spark.conf.set(rows, str(min(allowed, BATCH_ROWS) if allowed > 0 else BATCH_ROWS))
    spark.conf.set(size, f"{BATCH_BYTES}b")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def removed(*tables: DataFrame) -> None:
    """Removes tables of ``written``, not partitioned, that nothing reads any more."""
    for df in tables:
        for folder in _folders(df):
            _delete(df.sparkSession, folder)


def _folders(df: DataFrame) -> set[str]:
    return {f.rsplit("/", 1)[0] for f in df.inputFiles()}


def _delete(spark: SparkSession, folder: str) -> None:
    place, files = _files(spark, folder)
    files.delete(place, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Removes the tables written within at its end, but for those that its reader puts in the list.

    Only what no other table is still to be computed from may go, so the results are to be written
    before the end.
    """
    kept: list[DataFrame] = []
    outer, made = _MADE.get(), []
    token = _MADE.set(made)
    try:
        yield kept
    finally:
        _MADE.reset(token)
        stay = {folder.rsplit("/", 1)[-1] for df in kept for folder in _folders(df)}
        for path in made:
            if path.rsplit("/", 1)[-1] not in stay:
                _delete(spark, path)
            elif outer is not None:
                outer.append(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def shuffle_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
