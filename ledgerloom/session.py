"""Session settings, and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even where that costs a shuffle after the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # rows with arrays take some ten times their shuffled size in memory, where a task sorts them
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
}
#: Bytes of compressed input to a shuffle partition, before AQE puts small ones together.
INPUT_PER_PARTITION = 2 << 20
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: How parquet is written. A column leaves its dictionary when that is larger than this, and is written plain: looking up
#: nearly unique ids, times and names in the megabyte that is the default costs more than all else in a write.
PARQUET = {"compression": "zstd", "parquet.dictionary.page.size": str(64 << 10)}

_local_folders: dict[str, str] = {}


def build_session(app_name: str = "ledgerloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the models rely on. ``extra`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_settings(spark: SparkSession) -> None:
    """Give a session made elsewhere the same settings; the models need UTC and ANSI."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def scale_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Start shuffles with partitions in proportion to the input, so that a task sorts as much at any size."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(FIRST_PARTITIONS, str(max(least, -(-input_bytes // INPUT_PER_PARTITION))))


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle starts with."""
    return int(spark.conf.get(FIRST_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes in this block remove the files of their own shuffles when they are done, not when the driver's heap is full."""
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may run without that setting; it gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="ledgerloom-")
    return _local_folders[app]
