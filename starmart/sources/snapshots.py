"""Versions of a set of tables that readers see as a whole, switched by one small file.

A publication writes its files into a folder of its own, checks what it wrote, and then puts a
manifest: the list of folders that make up each table. The manifest with the highest number is
the current version. Until it is there readers see the version before, whatever has happened to
the files; after it they see all tables of the new one. Partitions that a publication does not
deliver are taken over from the version before by name, so a refreshed month costs a month.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from starmart.contracts import TableContract, conform
from starmart.sources.files import _files, path_exists, save
from starmart.sources.tables import in_partitions

# Names of partition folders that hold the load and the table, read as columns and dropped.
LOAD, TABLE = "__load", "__table"


@dataclass(frozen=True)
class Manifest:
    """One version: the folders of each table, relative to the data folder."""

    version: int
    folders: Mapping[str, list[str]]
    rolled_back_to: int | None = None
    note: str = ""


@dataclass(frozen=True)
class Snapshots:
    """The versions under ``root``. One publisher at a time; any number of readers.

    ``partition_by`` names the partition columns of the tables that have them, whose values are
    numbers or plain text.
    """

    spark: SparkSession
    root: str
    contracts: Mapping[str, TableContract]
    partition_by: Mapping[str, Sequence[str]] = field(default_factory=dict)

    @property
    def _data(self) -> str:
        return f"{self.root.rstrip('/')}/data"

    @property
    def _manifests(self) -> str:
        return f"{self.root.rstrip('/')}/manifests"

    def _listed(self, path: str) -> list[str]:
        if not path_exists(self.spark, path):
            return []
        place, files = _files(self.spark, path)
        return sorted(status.getPath().getName() for status in files.listStatus(place))

    def versions(self) -> list[int]:
        """The numbers of the published versions, in order."""
        return [int(n.removesuffix(".json")) for n in self._listed(self._manifests) if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> Manifest | None:
        """A version's manifest, the current one's by default; None before the first."""
        known = self.versions()
        if version is None:
            version = known[-1] if known else None
        elif version not in known:
            raise ValueError(f"version {version} is not published; there are {known}")
        if version is None:
            return None
        place, files = _files(self.spark, f"{self._manifests}/{version:012d}.json")
        stream = files.open(place)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Manifest(**json.loads(text))

    def _put(self, manifest: Manifest) -> None:
        """The switch: a finished file takes its name, which no version may have yet."""
        text = json.dumps({k: v for k, v in vars(manifest).items()}, sort_keys=True)
        fresh, files = _files(self.spark, f"{self._manifests}/.{uuid.uuid4().hex}")
        stream = files.create(fresh, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        place = _files(self.spark, f"{self._manifests}/{manifest.version:012d}.json")[0]
        if files.exists(place) or not files.rename(fresh, place):
            raise RuntimeError(f"version {manifest.version} was published by another run meanwhile")

    def _folders(self, load: str, name: str) -> list[str]:
        """Of a load's table: its partitions' folders, or the one folder of a table without."""
        top = f"{LOAD}={load}/{TABLE}={name}"
        depth = len(self.partition_by.get(name, ()))
        found = [top]
        for _ in range(depth):
            found = [f"{f}/{n}" for f in found for n in self._listed(f"{self._data}/{f}") if "=" in n]
        return found

    def _read(self, name: str, folders: Sequence[str]) -> DataFrame:
        contract = self.contracts[name]
        if not folders:
            return self.spark.createDataFrame([], contract.schema)
        schema = StructType(list(contract.schema)).add(LOAD, "string").add(TABLE, "string")
        reader = self.spark.read.schema(schema).option("basePath", self._data)
        rows = reader.parquet(*[f"{self._data}/{f}" for f in folders])
        return rows.select(*[f"`{f.name}`" for f in contract.schema])

    def read(self, version: int | None = None) -> dict[str, DataFrame]:
        """The tables of one version, the current one by default."""
        found = self.manifest(version)
        if found is None:
            raise ValueError(f"nothing is published under {self.root}")
        return {name: self._read(name, found.folders[name]) for name in self.contracts}

    def publish(
        self,
        tables: Mapping[str, DataFrame],
        partitions: Mapping[str, Sequence[tuple]] | None = None,
        check: Callable[[Mapping[str, DataFrame]], None] | None = None,
        rebalance: bool = True,
        note: str = "",
    ) -> int:
        """Write the tables, check them as written, and switch to them; returns the version.

        ``partitions`` names, for a partitioned table, the partitions that it replaces: rows of
        others are not written, and other partitions are those of the current version. A named
        partition without rows is empty from now on. Tables that are not given stay. ``check``
        gets all tables as readers will see them and raises to stop the switch.
        """
        base = self.manifest()
        missing = self.contracts.keys() - tables.keys() - (base.folders.keys() if base else set())
        if missing:
            raise ValueError(f"the first version needs every table: {sorted(missing)} are missing")
        load = uuid.uuid4().hex
        folders = {name: list(f) for name, f in (base.folders if base else {}).items()}
        for name, df in tables.items():
            keys = list(self.partition_by.get(name, ()))
            rows, named = conform(df, self.contracts[name]), (partitions or {}).get(name)
            if named is not None:
                rows = rows.where(in_partitions(named, keys))
            target = f"{self._data}/{LOAD}={load}/{TABLE}={name}"
            save(rows, target, partition_by=keys or None, rebalance=rebalance)
            kept = []
            if named is not None:
                gone = {"/".join(f"{k}={v}" for k, v in zip(keys, p, strict=True)) for p in named}
                kept = [f for f in folders.get(name, []) if f.split("/", 2)[-1] not in gone]
            folders[name] = sorted(kept + self._folders(load, name))
        if check is not None:
            check({name: self._read(name, folders[name]) for name in self.contracts})
        current = self.versions()
        if (current[-1] if current else None) != (base.version if base else None):
            raise RuntimeError("another run has published meanwhile; this one must start anew")
        version = base.version + 1 if base else 1
        self._put(Manifest(version, folders, note=note))
        return version

    def roll_back(self, version: int) -> int:
        """Switch to the tables of an earlier version, as a new one; no data is written."""
        old, now = self.manifest(version), self.manifest()
        self._put(Manifest(now.version + 1, old.folders, rolled_back_to=version))
        return now.version + 1

    def clean_up(self, keep: int | None = None) -> list[str]:
        """Remove the loads that no version refers to: those of runs that died, and with ``keep``
        those that only versions before the last ``keep`` refer to, manifests included.

        To be run by the publisher, while no publication runs. Returns the loads removed.
        """
        known = self.versions()
        dropped = known[:-keep] if keep else []
        used = {
            f.split("/", 1)[0]
            for v in known
            if v not in dropped
            for listed in self.manifest(v).folders.values()
            for f in listed
        }
        for version in dropped:
            place, files = _files(self.spark, f"{self._manifests}/{version:012d}.json")
            files.delete(place, False)
        removed = [n for n in self._listed(self._data) if n.startswith(f"{LOAD}=") and n not in used]
        for name in removed:
            place, files = _files(self.spark, f"{self._data}/{name}")
            files.delete(place, True)
        for name in self._listed(self._manifests):
            if name.startswith(".") and not name.endswith(".crc"):
                place, files = _files(self.spark, f"{self._manifests}/{name}")
                files.delete(place, False)
        return removed
