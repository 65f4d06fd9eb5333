"""Live liquidation events: decode, store per flush, summarise, and keep bucket sums.

A flush appends its events to the stored liquidation table, the one that dashboards read, as a batch with a name: the stream
and its number. A flush that is replayed after a lost executor or driver finds its name committed and stores nothing twice.
A stream that is behind works on many flushes at once: their rows are written by the same jobs and lie together, and the commits of
many flushes, each with its own number, are made by one file.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import constants as C
from tidemark.operators import dashboard as D
from tidemark.operators import normalize as N
from tidemark.sources import tables as TB
from tidemark.sources.ledger import Ledger, Rollup, new_attempt
from tidemark.streaming import landed

FLUSH_EVENTS = 25
FLUSH_SECONDS = 10
FLUSH_INTERVAL = f"{FLUSH_SECONDS} seconds"
#: Flushes that a stream which is behind works on at once.
BACKLOG = 1024
LATE_LIMIT = "1 day"
_BUCKET_KEYS = [*C.SERIES_KEY, "bucket_time", "day"]
BUCKETS = {
    "buckets": Rollup(
        "exchange string, symbol string, market_type string, bar_interval string, bucket_time timestamp, day date, "
        "long_value decimal(38,14), short_value decimal(38,14), total_value decimal(38,14), event_count bigint",
        _BUCKET_KEYS,
        {c: F.sum for c in D.LIQUIDATION_SUMS},
    )
}


def read_messages(
    spark: SparkSession, source: str, schema: str = "raw string", source_format: str = "parquet", **options: str
) -> DataFrame:
    """Messages with a `raw` JSON column: files that land in a folder, or a Kafka topic (value as text).

    Options pass through, such as maxFilesPerTrigger or maxOffsetsPerTrigger to cap one flush.
    """
    if source_format == "kafka":
        stream = spark.readStream.format("kafka").option("subscribe", source).options(**options).load()
        return stream.select(F.col("value").cast("string").alias("raw"))
    return spark.readStream.format(source_format).schema(schema).options(**options).load(source)


def read_landed(
    spark: SparkSession,
    folder: str,
    state: str,
    schema: str = "raw string",
    flush_events: int = FLUSH_EVENTS,
    flush_seconds: float = FLUSH_SECONDS,
    backlog: int = 1,
) -> DataFrame:
    """Messages that land in a folder, admitted by number or by delay (see landed.py), with their `position` and `flush`."""
    landed.register(spark)
    reader = spark.readStream.format(landed.NAME).schema(f"{schema}, position long, flush long").option("path", folder)
    bounds = {"flush_events": flush_events, "flush_seconds": flush_seconds, "backlog": backlog}
    return reader.options(state=state, **{k: str(v) for k, v in bounds.items()}).load()


def _name(checkpoint: str, batch_id: int | str) -> str:
    """A flush's name: the same again when it is replayed, another for another stream."""
    return f"{hashlib.sha1(checkpoint.encode()).hexdigest()[:16]}-{batch_id}"


def flush_summary(events: DataFrame, status: str = "success", error: str | None = None) -> DataFrame:
    """One run-log row per symbol of each `flush`: event-time range and counts."""
    stored = F.count(F.lit(1)) if status == "success" else F.lit(0)
    return (
        events.groupBy("job_name", *C.STREAM_KEY, F.col("flush").cast("bigint").alias("flush"))
        .agg(
            F.min("liquidation_time").alias("request_start"),
            F.max("liquidation_time").alias("request_end"),
            F.count(F.lit(1)).alias("rows_fetched"),
            stored.cast("bigint").alias("rows_inserted"),
        )
        .withColumn("status", F.lit(status))
        .withColumn("error_message", F.lit(error).cast("string"))
        .withColumn("rows_updated", F.lit(0).cast("bigint"))
    )


class _Counted:
    """How many events a query has stored."""

    def __init__(self) -> None:
        self.events = 0

    def add(self, events: int) -> None:
        self.events += events


def start_liquidation_stream(
    messages: DataFrame,
    jobs: DataFrame,
    events_path: str,
    log_path: str,
    checkpoint: str,
    drain: bool = False,
    unique: bool = False,
    max_events: int | None = None,
    ingested_at: Column | None = None,
    trigger: str = FLUSH_INTERVAL,
    on_stored: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Stores decoded events and one summary row per symbol for every flush.

    Flushes follow the trigger, or what the source admits if that is rarer; `drain=True` takes what is there and stops. Where
    messages have a `flush`, a batch of the stream may hold many flushes. `on_stored` is told how many events a batch had.
    Replayed messages are kept, as a plain append does; `unique=True` drops repeats of the same message that arrive within a
    day. With `max_events` the stream stores so many events and no more: messages must then have a `position`, by which the
    flush that reaches the bound is cut.
    """
    split = "flush" in messages.columns and not unique
    if not split:
        messages = N.decode_force_orders(messages.drop("flush"), jobs)
    if unique:
        messages = messages.withWatermark("liquidation_time", LATE_LIMIT).dropDuplicatesWithinWatermark(["native_symbol", "raw"])

    def flush(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if split:  # decoded here, so that a flush without events counts as well
            names = {r["flush"]: _name(checkpoint, f"at-{r['flush']}") for r in batch.select("flush").distinct().collect()}
            batch = N.decode_force_orders(batch, jobs)
        else:
            names = {batch_id: _name(checkpoint, batch_id)}
            batch = batch.withColumn("flush", F.lit(batch_id).cast("bigint"))
        if max_events is not None:
            stored = stream_totals(read_batches(spark, log_path)).first()["events_seen"] if Ledger.exists(spark, log_path) else 0
            if stored >= max_events:
                return
            batch = batch.orderBy("position").limit(max_events - stored)
        # kept on disk as well as in memory: read for the events, their summary and the log
        batch.persist()
        try:
            found = batch.agg(F.count(F.lit(1)).alias("events"), F.max("flush").alias("last")).first()
            if max_events is not None and stored + found["events"] >= max_events:  # the flush that reaches the bound is the last
                names = {n: name for n, name in names.items() if n <= found["last"]}
            at = F.current_timestamp() if ingested_at is None else ingested_at
            try:
                TB.append_flushed_liquidations(batch, events_path, at, names)
            except Exception as error:
                held = Ledger(spark, events_path).held(names.values()) if Ledger.exists(spark, events_path) else set()
                lost = batch.where(F.col("flush").isin([n for n, name in names.items() if name not in held]))
                TB.append_batch(flush_summary(lost, "failed", str(error)), log_path, [])
                raise
            TB.append_batches(flush_summary(batch).withColumn("_batch", F.col("flush")), "_batch", log_path, names, [])
            if on_stored is not None:
                on_stored(found["events"])
        finally:
            batch.unpersist()

    writer = messages.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=trigger)).start()


def run_liquidation_stream(
    folder: str,
    jobs: DataFrame,
    events_path: str,
    log_path: str,
    checkpoint: str,
    schema: str = "raw string",
    flush_events: int = FLUSH_EVENTS,
    flush_seconds: float = FLUSH_SECONDS,
    max_events: int | None = None,
    timeout_seconds: float | None = None,
    until_idle: bool = False,
) -> DataFrame:
    """Runs a stream over messages that land in a folder until a bound is reached, and returns its totals.

    Bounds: `max_events` stored events, `timeout_seconds`, or with `until_idle` the end of what has landed. What waits to be
    flushed when time is up is flushed once more before the stream ends.
    """
    spark, state = jobs.sparkSession, f"{checkpoint}.landed.json"
    if jobs.isEmpty():
        raise LookupError("There is no active liquidation job to stream for.")

    counts = _Counted()
    backlog = BACKLOG if max_events is None else 1  # no more is taken than one flush beyond the bound

    def start(seconds: float, drain: bool = False) -> StreamingQuery:
        messages = read_landed(spark, folder, state, schema, flush_events, seconds, backlog)
        return start_liquidation_stream(
            messages, jobs, events_path, log_path, checkpoint, drain, max_events=max_events, trigger="100 milliseconds", on_stored=counts.add
        )

    deadline = None if timeout_seconds is None else time.monotonic() + timeout_seconds
    query = start(0 if until_idle else flush_seconds)
    try:
        if until_idle and max_events is None and deadline is None:
            query.processAllAvailable()
        while query.isActive:
            if max_events is not None and counts.events >= max_events:
                break
            if deadline is not None and time.monotonic() >= deadline:
                break
            if until_idle and not query.status["isDataAvailable"] and not query.status["isTriggerActive"]:
                query.processAllAvailable()
                break
            query.awaitTermination(0.2)
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
    if deadline is not None and (max_events is None or counts.events < max_events):
        start(0, drain=True).awaitTermination()
    return stream_totals(read_batches(spark, log_path))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows of committed flushes."""
    return TB.read_table(spark, path)


def stream_totals(log: DataFrame) -> DataFrame:
    """Symbols seen, events seen and rows stored over all flushes."""
    return log.agg(
        F.countDistinct("symbol").alias("symbols"),
        F.coalesce(F.sum("rows_fetched"), F.lit(0)).alias("events_seen"),
        F.coalesce(F.sum("rows_inserted"), F.lit(0)).alias("rows_inserted"),
    )


def start_bucket_stream(
    events: DataFrame, path: str, checkpoint: str, intervals: str | list[str] = "1h", drain: bool = False
) -> StreamingQuery:
    """Keeps the sums of each market and bucket of some intervals; `latest_buckets` reads them.

    Sums are additive: a flush commits its own, no event is too late, and a flush that is run again adds nothing. Every so
    many flushes the sums of the days they touched are folded, so reading does not cost more the longer a stream runs.
    """

    def flush(batch: DataFrame, batch_id: int) -> None:
        ledger, name, attempt = Ledger(batch.sparkSession, path, BUCKETS), _name(checkpoint, batch_id), new_attempt()
        sums = D.liquidation_buckets(batch, [intervals] if isinstance(intervals, str) else intervals).withColumn("day", F.to_date("bucket_time"))
        ledger.write_part("buckets", sums.select(*[F.col(c).cast(kind) for c, kind in _BUCKET_TYPES]), attempt)
        ledger.commit(attempt, name)

    writer = events.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=FLUSH_INTERVAL)).start()


_BUCKET_TYPES = [tuple(x.split(" ", 1)) for x in BUCKETS["buckets"].schema.split(", ")]


def latest_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The sums of each bucket over all flushes."""
    return Ledger(spark, path, BUCKETS).read("buckets").drop("day")
