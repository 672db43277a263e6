"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BYTES_PER_SHUFFLE_PARTITION = 256 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 32_768
BYTES_PER_SCAN_TASK = 128 * 1024 * 1024
MAX_SCAN_TASKS = 100_000
CONCURRENT_FILES = 64

_local_dirs: dict[str, str] = {}
_sizes: dict[tuple[str, str], int] = {}


def prepare(
    spark: SparkSession,
    folder: str | None = None,
    max_partitions: int = MAX_SHUFFLE_PARTITIONS,
    max_tasks: int = MAX_SCAN_TASKS,
) -> SparkSession:
    """Pin the settings that results depend on, and size tasks to the input folder.

    Both sizes are only ever raised, for the rest of the session. Adaptive execution joins shuffle
    partitions that turn out small; the bounds keep the number of shuffle blocks (tasks times
    partitions) within what a driver can track. Beyond max_partitions times
    BYTES_PER_SHUFFLE_PARTITION, about 8 TB by default, a reduce task that gets its share of
    the whole input no longer fits in memory and spills; a larger driver can take higher bounds.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    # The JVM does not compile larger methods; Spark then generates them in parts.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    # A task writes its few partitions side by side, instead of sorting whole rows by them in memory.
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(CONCURRENT_FILES))
    if folder is not None:
        size = input_bytes(spark, folder)
        wanted = shuffle_partitions(size, max_partitions)
        if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
            spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
        if size > max_tasks * BYTES_PER_SCAN_TASK:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(scan_bytes(size, max_tasks)))
    return spark


def input_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes below a folder, asked of the file system once per session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _sizes:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        _sizes[key] = fs.getContentSummary(path).getLength()
    return _sizes[key]


def shuffle_partitions(size: int, most: int = MAX_SHUFFLE_PARTITIONS) -> int:
    """Enough partitions to fit a task's memory if all input were shuffled, up to the bound."""
    return min(most, -(-size // BYTES_PER_SHUFFLE_PARTITION))


def scan_bytes(size: int, most: int = MAX_SCAN_TASKS) -> int:
    """Bytes per scan task: Spark's default, more once that would make too many tasks."""
    return max(BYTES_PER_SCAN_TASK, -(-size // most))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local master, where driver and tasks share one machine, may fall back to
    a temporary folder.
    """
    named = spark.conf.get(_CHECKPOINT_KEY, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="faultline-")
    return _local_dirs[app]


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes in this block take what they shuffled off the disk as they end.

    Otherwise it lies there until the driver's garbage collector finds it unused. A write plans its rows
    anew, so nobody reads its shuffle files again.
    """
    before = spark.conf.get(_CLEANUP_KEY, None)
    spark.conf.set(_CLEANUP_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP_KEY)
        else:
            spark.conf.set(_CLEANUP_KEY, before)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
