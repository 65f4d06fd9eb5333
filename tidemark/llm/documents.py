"""Reading documents and walking Arrow batches in bounded pieces."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a task works on at a time; one longer text is a piece of its own.
PIECE_BYTES = 4 << 20


_shipped: set[str] = set()
_kept: dict[str, object] = {}


def kept(name: str, build: Callable[[], object]) -> object:
    """What a worker builds once and uses in many tasks; one thing at a time, so that a later operator's takes its place."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = build()
    return _kept[name]


def release() -> None:
    """Lets go of it, before work that needs the memory."""
    _kept.clear()


def give_back() -> None:
    """Hands freed memory to the system. A worker that waits for its next task, and is counted beside those that work, would
    keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library alone has it
    if trim:
        trim(0)


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(run: Task) -> Task:
    """The same task, after whose end its worker holds no freed memory."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def ship(spark: SparkSession) -> None:
    """Gives this package to the executors' Python, once for an application; they may not have it installed."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tidemark-")) / f"{package.name}.zip"  # the driver's own; it serves the file
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def load(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id` (long, null stays null) and `text` alone; other columns, whatever their names, are dropped."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, in order, cut so that a piece has about `limit` text bytes at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column(column)
        sizes = pa.compute.fill_null(pa.compute.binary_length(sizes), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def strings(piece: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a piece; null is the empty text."""
    return [x or "" for x in piece.column(column).to_pylist()]
