"""Loading contract tables and refreshing single partitions."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.contracts import TableContract, conform, misfits
from starmart.sources.files import Tally, save

OVERWRITE_MODE = "partitionOverwriteMode"
MONTH = ("i94yr", "i94mon")


def in_partitions(partitions: Sequence[tuple], partition_by: Sequence[str] = MONTH) -> Column:
    """Whether a row lies in one of the named partitions; one with a NULL key lies in none."""
    # Values of the last key stand together, so that a plan which puts a key's expression in its
    # place repeats that for each of the first keys' values, not for each partition.
    heads: dict[tuple, list] = {}
    for p in partitions:
        *head, last = [v for _, v in zip(partition_by, p, strict=True)]
        if None not in p:
            heads.setdefault(tuple(head), []).append(last)
    *firsts, last = [F.col(f"`{c}`") for c in partition_by]
    wanted = [reduce(and_, [k == v for k, v in zip(firsts, head, strict=True)], last.isin(found)) for head, found in heads.items()]
    return F.coalesce(reduce(or_, wanted, F.lit(False)), F.lit(False))


def _refuse(strays: DataFrame, what: str) -> None:
    """Stops the load if there is any such row."""
    n = strays.count()
    if n:
        raise ValueError(f"{n} rows {what}; name a rejects path to put them aside")


def _put_aside(strays: DataFrame, rejects: str, delivery: str) -> int:
    """Writes rows to the delivery's own folder under ``rejects`` and returns how many they are.

    Other deliveries' rows stay; the same delivery, run again, replaces its own.
    """
    tally = Tally(strays, {"n": F.count(F.lit(1))})
    save(tally.rows, f"{rejects.rstrip('/')}/delivery={delivery}")
    return tally.result["n"]


class _Sifted:
    """A delivery whose rows are told apart while they are written, in one pass over the source.

    Rows that meet a condition are left out of ``kept`` and counted under its name on the way;
    only if there are any is the source read again, for those alone.
    """

    def __init__(self, df: DataFrame, conditions: dict[str, Column]) -> None:
        self.df = df
        self.first: dict[str, Column] = {}  # the first condition that a row meets
        before = F.lit(False)
        for name, met in conditions.items():
            self.first[name] = met & ~before
            before = before | met
        self.tally = Tally(df, {name: F.count_if(met) for name, met in self.first.items()})
        self.kept = self.tally.rows.where(~before)

    def put_aside(self, rejects: Mapping[str, str], delivery: str, read: bool) -> int:
        """After ``kept`` was written if ``read``, else before: the rows left out, by condition."""
        n = 0
        for name, met in self.first.items():
            if not read or self.tally.result[name]:
                n += _put_aside(self.df.where(met), rejects[name], delivery)
        return n


def _is_dynamic(spark: SparkSession, table: str) -> bool:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(
        F.col("data_type").contains(f"{OVERWRITE_MODE}=dynamic")
    )
    return not rows.isEmpty()


def load_table(
    df: DataFrame,
    contract: TableContract,
    table: str | None = None,
    mode: str = "append",
    path: str | None = None,
    partition_by: Sequence[str] | None = None,
    fmt: str = "parquet",
    partitions: Sequence[tuple] | None = None,
    rejects: str | None = None,
    rebalance: bool = True,
    delivery: str | None = None,
) -> str:
    """Load rows into a catalog table in the contract's layout; returns the table name.

    ``mode`` is ``append``, ``overwrite``, or ``refresh``: replace the named ``partitions`` and no
    others. A delivery with rows outside them, or with a NULL partition key, stops the load, as
    does a value that does not fit the contract; with a ``rejects`` path such rows are put there
    instead, in a folder of its own for each ``delivery``, which is a new name unless one is given.
    A standing table is overwritten in place: it never goes missing in between. A new one is made
    empty and then filled, so that a load that failed can simply be run again.
    ``path`` places a new table outside the warehouse folder. ``rebalance=False`` saves a
    shuffle for rows that already come partition by partition.
    """
    spark = df.sparkSession
    name = table or contract.name
    keys = list(partition_by or ())
    conditions: dict[str, Column] = {}
    if mode == "refresh":
        if not keys:
            raise ValueError("a refresh needs the partition columns")
        if partitions is None:
            raise ValueError("a refresh needs the delivered partitions")
        outside = ~in_partitions(partitions, keys)
        if rejects is None:
            _refuse(df.where(outside), "lie outside the refresh")
        conditions["outside"] = outside
    if rejects is not None:
        conditions["misfits"] = misfits(df, contract)
    delivery = delivery or uuid.uuid4().hex
    sifted = _Sifted(df, conditions)
    aside = {kind: f"{rejects}/{kind}" for kind in conditions}
    if rejects is not None and mode == "append":
        # Rows added twice stay twice, so nothing may fail after them.
        sifted.put_aside(aside, delivery, read=False)
    rows = conform(sifted.kept, contract)
    if keys and rebalance:
        rows = rows.hint("rebalance", *[F.col(f"`{c}`") for c in keys])
    if not spark.catalog.tableExists(name):
        # The table is made empty, then filled like any other: a load that fails leaves a table
        # without rows, and files of its killed tasks where readers pass them over, so that the
        # next load under this name finds nothing in its way.
        empty = spark.createDataFrame([], rows.schema).write.format(fmt)
        if keys:
            # Kept with the table, so that inserts replace only the partitions they hold.
            empty = empty.partitionBy(*keys).option(OVERWRITE_MODE, "dynamic")
        if path is not None:
            empty = empty.option("path", path)
        empty.saveAsTable(name)
    elif mode == "refresh" and not _is_dynamic(spark, name):
        raise ValueError(f"{name} would be replaced whole: it was not made for refreshes")
    elif mode == "overwrite" and keys:
        raise ValueError("a partitioned table is refreshed by naming its partitions")
    # Inserts go by position: take the order of the table, where partitions are last.
    ordered = rows.select(*[f"`{c}`" for c in spark.table(name).columns])
    into = "overwrite" if mode == "refresh" or (mode == "overwrite" and not keys) else "append"
    ordered.write.mode(into).insertInto(name)
    if rejects is not None and mode != "append":
        sifted.put_aside(aside, delivery, read=True)
    return name


def upsert_partitions(
    df: DataFrame,
    path: str,
    partitions: Sequence[tuple],
    partition_by: Sequence[str] = MONTH,
    rebalance: bool = True,
    rejects: str | None = None,
    delivery: str | None = None,
) -> int:
    """Replace the named partitions by their rows in ``df``; all others stay as they are.

    Rows of other partitions, or with a NULL key, are never written over anything: they go to
    the ``rejects`` path, in a folder for each ``delivery``, and their number is returned, or stop
    the load where there is none. The delivery is read once, and again for rejected rows only if
    it held any. A named partition without rows stays. Running one delivery twice under one name
    leaves the same rows, rejected ones too.
    """
    outside = ~in_partitions(partitions, partition_by)
    if rejects is None:
        _refuse(df.where(outside), "lie outside the named partitions")
    sifted = _Sifted(df, {"outside": outside})
    save(
        sifted.kept,
        path,
        mode="overwrite",
        partition_by=partition_by,
        rebalance=rebalance,
        partitionOverwriteMode="dynamic",
    )
    if rejects is None:
        return 0
    return sifted.put_aside({"outside": rejects}, delivery or uuid.uuid4().hex, read=True)
