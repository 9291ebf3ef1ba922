"""Where staged tables go, and how tasks open files.

Staged tables live in the shared folder the cluster names in
``spark.checkpoint.dir``, so a lost executor loses none of them.
"""

from __future__ import annotations

import re
import tempfile
import threading
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import TypeVar
from urllib.parse import quote

from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Result = TypeVar("Result")

# Folders handed out in this driver, for ``clear_scratch``.
_scratch_folders: list[str] = []


def use_local_checkpoint_dir(spark: SparkSession) -> None:
    """For entry points, bench and tests: give a session on one machine that names
    no folder for staged tables one of its own. A cluster must name a shared one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and re.match(r"local(\[|$)", spark.sparkContext.master):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="filestrata-"))


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    base = (spark.conf.get("spark.checkpoint.dir", None)
            or spark.sparkContext.getCheckpointDir())
    if not base:
        raise ValueError("Set spark.checkpoint.dir to a folder all executors share.")
    folder = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _scratch_folders.append(folder)
    return folder


def scratch_mark() -> int:
    """How many folders are handed out so far, see ``clear_scratch``."""
    return len(_scratch_folders)


def clear_scratch(spark: SparkSession, since: int = 0, keep: Sequence[str] = ()) -> None:
    """Delete the folders this driver staged tables in, ``since`` a mark.

    For the end of a job, or of an application: lazily read frames need their
    staged tables. Jobs that end with this run one at a time in a driver.
    """
    kept = []
    while len(_scratch_folders) > since:
        folder = _scratch_folders.pop()
        if folder in keep:
            kept.append(folder)
            continue
        delete_path(spark, folder)
    _scratch_folders.extend(kept)


def stage(
    df: DataFrame, label: str, partition_by: Sequence[str] = (), rows_per_file: int = 0,
    codec: str | None = None,
) -> str:
    """Write a frame to the scratch folder; returns where.

    ``rows_per_file`` is for rows of megabytes: Parquet is read thousands of rows at
    a time, so only the rows of a file bound what a task holds. ``codec`` is how Parquet
    compresses, if not as the session says.
    """
    path = scratch_dir(df.sparkSession, label)
    writer = df.write.option("maxRecordsPerFile", rows_per_file).partitionBy(*partition_by)
    (writer.option("compression", codec) if codec else writer).parquet(path)
    return path


def materialize(df: DataFrame, label: str, rows_per_file: int = 0) -> DataFrame:
    """Write a frame to the scratch folder and read it back: lineage ends here."""
    return df.sparkSession.read.schema(df.schema).parquet(
        stage(df, label, rows_per_file=rows_per_file))


# Of files that a task opens one after the other: so many, or so many bytes. Files whose
# bytes are not known may each be large.
FILES_PER_TASK = 64
SIZED_FILES_PER_TASK = 2_000
BYTES_PER_TASK = 256 * 1024 * 1024


def spread_files(
    files: DataFrame, tasks: int | None = None, files_per_task: int | None = None,
) -> DataFrame:
    """Deal file rows out evenly to tasks before work that opens each file.

    A row is a few bytes but its file may be large, so the number of tasks is
    given outright, from the number of files and, where known, their bytes:
    adaptive coalescing would merge such tiny partitions. A task costs as much as
    opening a thousand small files, so files of known sizes share one.
    """
    spark = files.sparkSession
    if tasks is None:
        sized = "file_size_bytes" in files.columns
        per_task = files_per_task or (SIZED_FILES_PER_TASK if sized else FILES_PER_TASK)
        size = F.sum("file_size_bytes") if sized else F.lit(0)
        n, size = files.agg(F.count(F.lit(1)), size).first()
        least = max(spark.sparkContext.defaultParallelism,
                    int(spark.conf.get("spark.sql.shuffle.partitions")))
        wanted = max(least, -(-n // per_task), -(-(size or 0) // BYTES_PER_TASK))
        tasks = max(1, min(n, wanted))
    return files.repartition(tasks)


_LIST_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_listing = threading.Lock()


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """For opening a reader on many paths: Spark lists each in a task of its own, up to
    10,000 of them, which costs more than reading small files. Here a few tasks a core."""
    few = 4 * spark.sparkContext.defaultParallelism
    # One at a time, so that the session's own setting is what is put back.
    with _listing:
        own = spark.conf.get(_LIST_TASKS)
        spark.conf.set(_LIST_TASKS, min(int(own), few))
        try:
            yield
        finally:
            spark.conf.set(_LIST_TASKS, own)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_dropping = threading.Lock()
# Who drops shuffles now, by session, and what the session itself said.
_droppers: dict[str, tuple[int, str | None]] = {}


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run meanwhile go at its end. Else they stay until the driver
    happens to collect its garbage, long after the rows are staged. May be entered by many
    threads; a frame that is run again shuffles again."""
    key = spark._jsparkSession.sessionUUID()
    with _dropping:
        n, own = _droppers.get(key, (0, spark.conf.get(_DROP_SHUFFLES, None)))
        _droppers[key] = n + 1, own
        spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _dropping:
            n, own = _droppers.pop(key)
            if n > 1:
                _droppers[key] = n - 1, own
            elif own is None:
                spark.conf.unset(_DROP_SHUFFLES)
            else:
                spark.conf.set(_DROP_SHUFFLES, own)


def _hadoop(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    filesystem, target = _hadoop(spark, path)
    return filesystem.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    filesystem, target = _hadoop(spark, path)
    filesystem.delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none if it is missing."""
    filesystem, target = _hadoop(spark, path)
    if not filesystem.exists(target):
        return []
    return [status.getPath().getName() for status in filesystem.listStatus(target)]


def literal_paths(paths: Sequence[str]) -> list[str]:
    """Escape glob characters so a reader takes each path as it is written."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", path) for path in paths]


def task_filesystem(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and inner path for use inside a task."""
    path = re.sub(r"^file:/+", "/", path)
    if "://" not in path:
        return arrow_fs.LocalFileSystem(), path
    scheme, rest = path.split("://", 1)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return arrow_fs.FileSystem.from_uri(f"{scheme}://{quote(rest)}")


def with_attempts(
    action: Callable[[], Result], attempts: int = 3, delay_seconds: float = 2.0,
    retry_on: type[Exception] = Exception,
) -> tuple[Result, int]:
    """Run an action again after a failure; returns its result and the retries."""
    for attempt in range(attempts):
        try:
            return action(), attempt
        except retry_on:
            if attempt == attempts - 1:
                raise
            time.sleep(delay_seconds)
    raise ValueError("attempts must be at least 1")
