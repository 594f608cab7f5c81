"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Size of merged or split shuffle partitions, and so of the files of a rebalanced write.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Plans here are many small expressions; noting the call site of each doubles the time
    # it takes to state them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# One shuffle partition per this much input. Adaptive execution merges partitions that turn
# out small but cannot add any, so the number is set for the largest shuffle.
SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024


def shuffle_partitions(input_bytes: int, least: int = 200) -> int:
    """As many as keep a partition at its size: 409,600 for 100 TiB."""
    return max(least, -(-input_bytes // SHUFFLE_PARTITION_BYTES))


def get_or_create(
    app_name: str = "starmart",
    hive: bool = False,
    input_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with our SQL defaults; ``conf`` entries (dots as ``__``) override them.

    ``hive`` keeps the tables in a Hive metastore, so that they outlive the session.
    ``input_bytes``, the size of the largest source, sets the number of shuffle partitions.
    Executors and memory are left to spark-submit.
    """
    builder = SparkSession.builder.appName(app_name)
    if hive:
        builder = builder.enableHiveSupport()
    sized = {}
    if input_bytes is not None:
        sized["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    settings = {**DEFAULTS, **sized, **{k.replace("__", "."): str(v) for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _machine_folder() -> tempfile.TemporaryDirectory:
    """One folder per process, gone when the process ends."""
    return tempfile.TemporaryDirectory(prefix="starmart-", ignore_cleanup_errors=True)


def _application_folder(spark: SparkSession, base: str) -> str:
    """This application's own folder in the shared one, gone when its driver ends."""
    folder = f"{base.rstrip('/')}/starmart-{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)
    return folder


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path for intermediate tables that every executor can reach.

    It lies in the folder the cluster names in ``spark.checkpoint.dir`` and is removed with all
    it holds when the driver ends. Only a local master may fall back to a temporary folder of
    this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _machine_folder().name
    return f"{_application_folder(spark, base)}/{label}-{uuid.uuid4().hex}"
