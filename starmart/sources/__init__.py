from starmart.sources.checked import land_checked, read_checked
from starmart.sources.files import (
    land,
    path_exists,
    read_lookup,
    read_source,
    save,
)
from starmart.sources.merge import KeyIndex, merge_rows
from starmart.sources.snapshots import Snapshots
from starmart.sources.tables import load_table, upsert_partitions

__all__ = [
    "KeyIndex",
    "Snapshots",
    "land",
    "land_checked",
    "load_table",
    "merge_rows",
    "path_exists",
    "read_checked",
    "read_lookup",
    "read_source",
    "save",
    "upsert_partitions",
]
