"""Results written once to the shared folder and read back.

A staged table cuts the lineage, survives lost executors, is pruned by column when read, and has a known size, so
joins against a small one are broadcast by a measured size rather than by a hint.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_path

_stored: dict[tuple, tuple] = {}
_locks: dict[tuple, threading.Lock] = {}
_guard = threading.Lock()
#: Rows of one file. Rows that compress well fill few row groups, and a row group is read by one task.
FILE_ROWS = 250_000


def _write(rows: DataFrame, path: str, partition_by: tuple[str, ...], sort_by: tuple[str, ...]) -> None:
    spread = rows.hint("rebalance", *partition_by) if partition_by else rows
    out = spread.sortWithinPartitions(*partition_by, *sort_by) if sort_by else spread
    writer = out.write.partitionBy(*partition_by) if partition_by else out.write
    writer.option("maxRecordsPerFile", FILE_ROWS).parquet(path)


def settle(rows: DataFrame, name: str, partition_by: tuple[str, ...] = (), sort_by: tuple[str, ...] = ()) -> DataFrame:
    """Writes rows as a new Parquet table in the shared folder and returns it.

    Sorting inside each file keeps a series together, so row groups are skipped when one series is read.
    """
    path = scratch_path(rows.sparkSession, name)
    _write(rows, path, partition_by, sort_by)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on the file system of its path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def move_folders(spark: SparkSession, source: str, target: str, prefix: str, keep_prefix: bool = True) -> None:
    """Moves the folders of `source` whose names have a prefix into `target`; nothing there may have their names."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(target))
    for status in files.listStatus(path(source)):
        name = status.getPath().getName()
        if name.startswith(prefix):
            moved = path(target, name if keep_prefix else name.removeprefix(prefix))
            if not files.rename(status.getPath(), moved):
                raise OSError(f"{status.getPath().toString()} could not be moved to {target}.")


def source_version(spark: SparkSession, path: str) -> tuple:
    """Path, time and size of a source file or folder; changes when the data is replaced."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    status = files.getFileStatus(folder)
    return (path, status.getModificationTime(), files.getContentSummary(folder).getLength())


def settle_once(
    spark: SparkSession,
    version: tuple,
    name: str,
    build: Callable[[], DataFrame],
    partition_by: tuple[str, ...] = (),
    sort_by: tuple[str, ...] = (),
) -> DataFrame:
    """One staged table per application, source version and name.

    `build()` runs for the first request, and again only if the shared folder has been cleared since.
    """
    key = (spark.sparkContext.applicationId, *version, name)
    with _guard:
        lock = _locks.setdefault(key, threading.Lock())
    with lock:
        if key not in _stored or not path_exists(spark, _stored[key][0]):
            rows, path = build(), scratch_path(spark, name)
            _write(rows, path, partition_by, sort_by)
            _stored[key] = (path, rows.schema)
    path, schema = _stored[key]
    return spark.read.schema(schema).parquet(path)


def settled_once() -> set[tuple]:
    """What `settle_once` holds so far."""
    return set(_stored)


def forget_except(kept: set[tuple]) -> None:
    """Lets the tables settled since go, so that what needs them builds them again."""
    with _guard:
        for key in set(_stored) - kept:
            del _stored[key]
