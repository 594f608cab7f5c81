"""Corrections by key: find the partitions that hold the keys, rewrite those and no others.

Every load of a published table has an index: for each partition the range of its keys and a
Bloom filter, cut into bitmaps of one size so that a key looks into one of them alone. An index is
as immutable as the files it describes, and kept beside them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.joins import fits_broadcast
from starmart.session import scratch_dir
from starmart.sources.files import path_exists, save
from starmart.sources.snapshots import LOAD, Snapshots

BITMAP = 32_768  # bits, the size of Spark's bitmaps
PER_KEY = 12  # bits: with four hashes one strange key in 300 seems to be there
HASHES = 4
SIZES = 40  # a partition has a power of two of bitmaps


def _hash(key: str) -> Column:
    return F.xxhash64(F.col(key))


def _bits(key: str) -> list[Column]:
    """The places of a key within its bitmap."""
    return [F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(BITMAP)) for i in range(1, HASHES + 1)]


def _has(bitmap: str, place: Column) -> Column:
    byte = F.substring(F.col(bitmap), (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int")) == 1


class KeyIndex:
    """The index of one partitioned table's key over its published loads."""

    def __init__(self, snapshots: Snapshots, table: str, key: str) -> None:
        self.snapshots, self.table, self.key = snapshots, table, key
        self.keys = list(snapshots.partition_by[table])
        self.path = f"{snapshots.root.rstrip('/')}/index/{table}-{key}"

    def _folders(self) -> list[str]:
        found = self.snapshots.manifest()
        return list(found.folders[self.table]) if found else []

    def build(self) -> None:
        """Index the loads of the current version that have none yet, each from its key column alone."""
        loads: dict[str, list[str]] = {}
        for folder in self._folders():
            loads.setdefault(folder.split("/", 1)[0], []).append(folder)
        for load in loads:
            place = f"{self.path}/{load}"
            if not path_exists(self.snapshots.spark, f"{place}/_SUCCESS"):
                # All that the load wrote, so that it holds whichever version lists it.
                whole = self.snapshots._folders(load.removeprefix(f"{LOAD}="), self.table)
                save(self._of(self.snapshots._read(self.table, whole)), place)

    def _of(self, rows: DataFrame) -> DataFrame:
        rows = rows.select(*self.keys, self.key).where(F.col(self.key).isNotNull())
        sizes = rows.groupBy(*self.keys).agg(
            F.count(F.lit(1)).alias("n"), F.min(self.key).alias("low"), F.max(self.key).alias("high"))
        needed = F.greatest(F.ceil(F.col("n") * PER_KEY / BITMAP), F.lit(1))
        sizes = sizes.withColumn("bitmaps", F.pow(F.lit(2), F.ceil(F.log2(needed))).cast("long")).drop("n")
        if fits_broadcast(sizes):
            sizes = F.broadcast(sizes)
        placed = rows.join(sizes, self.keys).withColumn("bitmap", F.pmod(_hash(self.key), F.col("bitmaps")))
        bits = placed.withColumn("bit", F.explode(F.array(*_bits(self.key))))
        return bits.groupBy(*self.keys, "low", "high", "bitmaps", "bitmap").agg(
            F.bitmap_construct_agg(F.col("bit")).alias("bits"))

    def partitions_of(self, wanted: DataFrame) -> list[tuple]:
        """The partitions of the current version that may hold one of the keys, and no other.

        None that holds one is missing. ``wanted`` has the key; it is joined by bitmap, once for
        each number of bitmaps that a partition has.
        """
        spark, folders = self.snapshots.spark, self._folders()
        if not folders:
            return []
        self.build()
        # A row for each partition of the version.
        listed = spark.createDataFrame([(f.split("/", 1)[0].removeprefix(f"{LOAD}="), f.split("/", 2)[-1]) for f in folders], "load string, part string")
        index = spark.read.option("basePath", self.path).parquet(*sorted({f"{self.path}/{f.split('/', 1)[0]}" for f in folders}))
        named = F.concat_ws("/", *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in self.keys])
        index = index.withColumns({"part": named, "load": F.col(LOAD).cast("string")}).join(listed, ["load", "part"], "left_semi")
        sizes = [r["bitmaps"] for r in index.select("bitmaps").distinct().collect()]
        asked = wanted.select(self.key).distinct().withColumn("bitmaps", F.explode(F.array(*[F.lit(s) for s in sizes])))
        asked = asked.withColumn("bitmap", F.pmod(_hash(self.key), F.col("bitmaps")))
        met = asked.join(index, ["bitmaps", "bitmap"]).where(F.col(self.key).between(F.col("low"), F.col("high")))
        for bit in _bits(self.key):
            met = met.where(_has("bits", bit))
        return sorted(tuple(r) for r in met.select(*self.keys).distinct().collect())


def merge_rows(
    snapshots: Snapshots, table: str, delivery: DataFrame, key: str, latest: Sequence[str] = ()
) -> tuple[int, list[tuple]]:
    """Publish a table with the delivered rows in place of those with their keys, and new ones added.

    Of several delivered rows of a key the one with the greatest ``latest`` columns counts, or the
    greatest row. A row may move to another partition. Only partitions that may hold a delivered
    key, or get a row, are read and written. A row without a key or a partition stops the merge.
    Merging a delivery again changes no row. Returns the version and the partitions rewritten.
    """
    keys = list(snapshots.partition_by[table])
    columns = [f.name for f in snapshots.contracts[table].schema]
    missing = F.lit(False)
    for c in (key, *keys):
        missing = missing | F.col(c).isNull()
    strays = delivery.where(missing).count()
    if strays:
        raise ValueError(f"{strays} rows have no {key} or no partition")
    others = [c for c in columns if c != key]
    best = F.max(F.struct(*[F.col(c).alias(f"__{i}") for i, c in enumerate(latest)], *others)).alias("__row")
    fresh = delivery.groupBy(key).agg(best).select(key, *[F.col("__row").getField(c).alias(c) for c in others])
    staged = scratch_dir(snapshots.spark, "corrections")
    save(fresh.select(*columns), staged)
    fresh = snapshots.spark.read.parquet(staged)
    held = KeyIndex(snapshots, table, key).partitions_of(fresh)
    # A row for each partition that gets one.
    touched = sorted({*held, *[tuple(r) for r in fresh.select(*keys).distinct().collect()]})
    names = {"/".join(f"{k}={v}" for k, v in zip(keys, p, strict=True)) for p in touched}
    folders = [f for f in snapshots.manifest().folders[table] if f.split("/", 2)[-1] in names]
    stored = snapshots._read(table, folders)
    merged = stored.join(fresh.select(key), key, "left_anti").select(*columns).unionByName(fresh)
    version = snapshots.publish({table: merged}, {table: touched}, note=f"merged by {key}")
    KeyIndex(snapshots, table, key).build()
    return version, touched
