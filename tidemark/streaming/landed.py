"""Messages that land as Parquet files, admitted by number or by delay.

A flush takes `flush_events` messages as soon as so many are waiting, or all that wait once the first of them has waited
`flush_seconds`, whichever comes first. Where more are waiting, a batch may take several flushes, `backlog` at most; the column
`flush` tells them apart: the position at which a message's flush begins. Spark's file source admits whole files; this source
counts messages. Its offset is the position of a message among all that have landed, in the order in which their files were found. That order and the
admitted end are kept in one small file beside the checkpoint, which is replaced as a whole before an offset is given out, so
a restart repeats the same flushes. The file has a line for each landed file.

For Kafka the broker's offsets do this: see `kafka_flushes`.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "landed_messages"
#: Messages that one task reads.
SLICE = 10_000


def _files_of(path: str) -> tuple[pa.fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pa.fs.FileSystem.from_uri(path)


class Slice(InputPartition):
    def __init__(self, path: str, first: int, count: int, position: int, start: int):
        self.path, self.first, self.count, self.position, self.start = path, first, count, position, start


class Landing:
    """What has landed and how much of it is admitted; kept in one file."""

    def __init__(self, folder: str, state: str):
        self.folder, self.state = folder, state
        self.files: list[list] = []
        self.end = 0
        store, path = _files_of(state)
        if store.get_file_info(path).is_file:
            with store.open_input_stream(path) as held:
                self.files, self.end = json.loads(held.read())
        self.known = {name for name, _ in self.files}

    def save(self) -> None:
        store, path = _files_of(self.state)
        store.create_dir(path.rsplit("/", 1)[0])
        with store.open_output_stream(f"{path}.next") as out:
            out.write(json.dumps([self.files, self.end]).encode())
        store.move(f"{path}.next", path)

    def discover(self) -> int:
        """Looks for new files, oldest first, and returns how many messages have landed."""
        store, root = _files_of(self.folder)
        listed = [x for x in store.get_file_info(pa.fs.FileSelector(root, allow_not_found=True)) if x.is_file]
        new = [x for x in listed if x.base_name.endswith(".parquet") and x.base_name[0] not in "._" and x.base_name not in self.known]
        for info in sorted(new, key=lambda x: (x.mtime_ns or 0, x.base_name)):
            with store.open_input_file(info.path) as opened:
                self.files.append([info.base_name, pq.ParquetFile(opened).metadata.num_rows])
            self.known.add(info.base_name)
        if new:
            self.save()
        return sum(rows for _, rows in self.files)

    def slices(self, start: int, end: int) -> Iterator[Slice]:
        at = 0
        for name, rows in self.files:
            first, last = max(start, at), min(end, at + rows)
            for begin in range(first, last, SLICE):
                yield Slice(f"{self.folder}/{name}", begin - at, min(SLICE, last - begin), begin, start)
            at += rows


class LandedReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.names = [f.name for f in schema.fields]
        self.columns = [x for x in self.names if x not in ("position", "flush")]
        self.rows, self.seconds = int(options.get("flush_events", 25)), float(options.get("flush_seconds", 10))
        self.backlog = int(options.get("backlog", 1))
        self.folder, self.state = options["path"].rstrip("/"), options["state"]
        self.landing: Landing | None = None
        self.waiting_since: float | None = None

    def _landing(self) -> Landing:
        if self.landing is None:
            self.landing = Landing(self.folder, self.state)
        return self.landing

    def initialOffset(self) -> dict:
        return {"position": 0}

    def latestOffset(self) -> dict:
        landing = self._landing()
        waiting = landing.discover() - landing.end
        if waiting <= 0:
            self.waiting_since = None
            return {"position": landing.end}
        if self.waiting_since is None:
            self.waiting_since = time.monotonic()
        if waiting >= self.rows or time.monotonic() - self.waiting_since >= self.seconds:
            landing.end += min(waiting // self.rows, self.backlog) * self.rows or waiting
            landing.save()
            self.waiting_since = None
        return {"position": landing.end}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return list(self._landing().slices(start["position"], end["position"]))

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        store, path = _files_of(partition.path)
        with store.open_input_file(path) as opened:
            file = pq.ParquetFile(opened)
            at, until = 0, partition.first + partition.count
            groups = []  # the row groups that hold rows of the slice; `at` is where the first of them begins
            for group in range(file.num_row_groups):
                rows = file.metadata.row_group(group).num_rows
                if not groups and at + rows <= partition.first:
                    at += rows
                elif at + sum(file.metadata.row_group(g).num_rows for g in groups) < until:
                    groups.append(group)
            for batch in file.iter_batches(batch_size=SLICE, row_groups=groups, columns=self.columns):
                if at >= until:
                    break
                first, last = max(partition.first, at) - at, min(until, at + batch.num_rows) - at
                if first < last:
                    part = batch.slice(first, last - first)
                    position = partition.position + at + first - partition.first
                    numbers = np.arange(position, position + part.num_rows, dtype=np.int64)
                    held = {c: part.column(c) for c in self.columns}
                    held["position"] = pa.array(numbers)
                    held["flush"] = pa.array(numbers - (numbers - partition.start) % self.rows)
                    yield pa.RecordBatch.from_arrays([held[x] for x in self.names], self.names)
                at += batch.num_rows

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class LandedMessages(DataSource):
    """Options: path, state, flush_events, flush_seconds, backlog. Columns: those asked for, the message's `position`, its `flush`."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "raw string, position long"

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return LandedReader(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    """Makes the source known; its code goes with it, so executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(LandedMessages)


def kafka_flushes(flush_events: int, flush_seconds: int) -> dict[str, str]:
    """Options of Spark's Kafka source for the same rule: so many messages at least, or what there is after the delay."""
    return {
        "minOffsetsPerTrigger": str(flush_events),
        "maxOffsetsPerTrigger": str(flush_events),
        "maxTriggerDelay": f"{flush_seconds}s",
    }
