"""Stored tables on Parquet: reads, insert-if-absent, upsert, plain append, run log.

Fact tables are partitioned by the write (`attempt`), by their layout columns and by day. Plain Parquet has no MERGE, so
  * insert-if-absent = first row per key in the batch, minus keys already stored in the partitions it touches, appended;
  * upsert = last row per key over (stored, batch), written as a new snapshot.
Several writers may work on a table. A write counts once it has its number in the table's ledger (see ledger.py); a writer
that finds its number taken looks at what was committed meanwhile: an insert drops the keys that came first, an upsert is
merged again. A batch with a name is stored once, however often it is run. Fact tables keep a summary by stream and day with
each commit (see summary.py).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import constants as C
from tidemark import schemas as S
from tidemark.sources import ledger as LG
from tidemark.sources import summary as SU
from tidemark.sources.ledger import SEPARATOR, Ledger, Rollup, new_attempt
from tidemark.sources.staging import move_folders, path_exists, settle

DAY_COLUMN = "day"
ATTEMPT = "attempt"
DAYS = {"days": Rollup(SU.SCHEMA, SU.STREAM_DAY, SU.MERGED)}
DATASET = {
    "open_interest_history": "open_interest",
    "funding_rate_history": "funding_rate",
    "long_short_ratio_history": "long_short_ratio",
    "taker_buy_sell_volume_history": "taker_buy_sell_volume",
    "liquidation_event": "liquidation",
}


# --- reading -----------------------------------------------------------------------


def read_table(spark: SparkSession, source: str, schema: T.StructType | str | None = None, **options: str) -> DataFrame:
    """A stored table: a Parquet path, or a JDBC url (starting with `jdbc:`) with `dbtable` and the usual options.

    Of a table with a ledger the committed rows are read. JDBC reads run in one task unless partitionColumn, lowerBound,
    upperBound and numPartitions are given.
    """
    if source.startswith("jdbc:"):
        return spark.read.format("jdbc").option("url", source).options(**options).load()
    if Ledger.exists(spark, source):
        return _committed(spark, source, schema).drop(ATTEMPT)
    reader = spark.read.options(**options)
    return (reader if schema is None else reader.schema(schema)).parquet(source)


def _committed(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, after: int = 0, upto: int | None = None
) -> DataFrame:
    """The rows of commits with their attempt; of all, or of those with numbers over `after` up to `upto`."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if schema is not None:  # stated even where no commit has rows, so that there are no folders to find them by
        held = set(schema.fieldNames())
        added = [T.StructField(n, k) for n, k in ((DAY_COLUMN, T.DateType()), (ATTEMPT, T.StringType())) if n not in held]
        schema = T.StructType([*schema.fields, *added])
    if not path_exists(spark, f"{path}/data"):
        return spark.createDataFrame([], schema or f"{DAY_COLUMN} date, {ATTEMPT} string")
    reader = spark.read if schema is None else spark.read.schema(schema)
    counted = Ledger(spark, path).commits(upto).where(F.col("number") > after)
    counted = counted.select(F.substring_index(ATTEMPT, SEPARATOR, 1).alias(ATTEMPT))
    return reader.parquet(f"{path}/data").join(counted, ATTEMPT, "left_semi")


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """The summary of a fact table by stream and day, kept by its appends."""
    return Ledger(spark, path, DAYS).read("days")


def conform(rows: DataFrame, table: str) -> DataFrame:
    """Rows cast and ordered to a table's schema; missing columns become NULL."""
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in S.schema_of(table).fields
        ]
    )


# --- insert if absent ------------------------------------------------------------------


def first_per_key(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """First row of each key by `order`; combines on the map side, so many copies of a key stay cheap."""
    values = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.min_by(F.struct(*values), order).alias("v")).select(*key, "v.*")


def absent_rows(batch: DataFrame, path: str, table: str, ingested_at: Column, order: str = "fetch_seq") -> DataFrame:
    """The batch rows to store: the first row of each key, minus keys stored already.

    The stored side is read only for the partitions that the batch touches. The batch is read twice (its partitions, its
    rows), so pass a stored or settled one.
    """
    key, time = S.UNIQUE_KEY[table], S.TIME_COLUMN[table]
    ordered = batch if order in batch.columns else batch.withColumn(order, F.lit(0))
    typed = ordered.select(*_typed_columns(ordered, table, ingested_at), F.col(order).alias("_order"))
    fresh = first_per_key(typed, key, "_order").select(*S.schema_of(table).fieldNames())
    fresh = fresh.withColumn(DAY_COLUMN, F.to_date(time))
    if not Ledger.exists(batch.sparkSession, path):
        return fresh
    return _not_stored(fresh, batch, path, table)


def _not_stored(fresh: DataFrame, batch: DataFrame, path: str, table: str, after: int = 0, upto: int | None = None) -> DataFrame:
    """Rows without a row of the same key in the commits of a table over `after`, `upto` the last."""
    key, time = S.UNIQUE_KEY[table], S.TIME_COLUMN[table]
    stored = _committed(fresh.sparkSession, path, _with_day(table), after, upto)
    return fresh.join(_touched(stored, batch, S.LAYOUT[table], time).select(*key), key, "left_anti").select(*fresh.columns)


def _with_day(table: str) -> T.StructType:
    return T.StructType([*S.schema_of(table).fields, T.StructField(DAY_COLUMN, T.DateType())])


def _touched(stored: DataFrame, batch: DataFrame, layout: list[str], time: str) -> DataFrame:
    """The stored rows of the partitions that the batch has rows for; a batch with one old row reads one old day more."""
    days = batch.groupBy(*[F.col(c) for c in layout]).agg(F.collect_set(F.to_date(time)).alias("days")).collect()
    wanted = F.lit(False)
    for part in days:
        here = F.col(DAY_COLUMN).isin(part["days"])
        for column in layout:
            here = here & F.col(column).eqNullSafe(F.lit(part[column]))
        wanted = wanted | here
    return stored.where(wanted)


def _summary(table: str) -> Callable[[DataFrame], DataFrame]:
    close = "close_time" if table == "market_data_raw" else None
    return lambda rows: SU.summarise(rows, S.TIME_COLUMN[table], DATASET.get(table), close)


def append_rows(fresh: DataFrame, path: str, table: str, seen: int, batch: str | None = None) -> int:
    """Stores rows of `absent_rows` in the table's layout and returns how many.

    `seen` is the table's last commit before these were made (see `last_commit`); keys that others have stored since are
    dropped. The rows are read several times, so pass settled ones.
    """
    ledger = Ledger(fresh.sparkSession, path, DAYS)
    while True:
        attempt = new_attempt()
        written = _write(fresh, path, attempt, [*S.LAYOUT[table], DAY_COLUMN], [*C.MARKET_KEY, S.TIME_COLUMN[table]])
        ledger.write_part("days", _summary(table)(fresh), attempt)
        if ledger.commit(attempt, batch, seen=seen):
            return written
        if batch is not None and ledger.has(batch):
            return 0
        before, seen = seen, ledger.log.newest()
        fresh = settle(_not_stored(fresh, fresh, path, table, after=before, upto=seen), "fresh")


def last_commit(spark: SparkSession, path: str) -> int:
    return Ledger(spark, path).log.newest()


def insert_if_absent(
    rows: DataFrame, path: str, table: str, ingested_at: Column, order: str = "fetch_seq", batch: str | None = None
) -> int:
    """Appends the rows whose key is not stored yet and returns how many. The first writer of a key wins.

    Running a batch again inserts nothing.
    """
    seen = last_commit(rows.sparkSession, path)
    fresh = settle(absent_rows(rows, path, table, ingested_at, order), "fresh")
    return append_rows(fresh, path, table, seen, batch)


def _typed_columns(rows: DataFrame, table: str, ingested_at: Column) -> list[Column]:
    cells = []
    for field in S.schema_of(table).fields:
        if field.name == "ingested_at":
            cell = ingested_at
        else:
            cell = F.col(field.name) if field.name in rows.columns else F.lit(None)
        cells.append(cell.cast(field.dataType).alias(field.name))
    return cells


def _write(rows: DataFrame, path: str, attempt: str, layout: list[str], sort_by: list[str] = ()) -> int:
    """Writes an attempt's rows and returns their number, counted by the same job.

    Rows are rebalanced by the partition columns, so a day is written by few tasks and a very large day by several.
    """
    written = Observation()
    spread = rows.hint("rebalance", *layout)
    ordered = spread.sortWithinPartitions(*layout, *sort_by) if [*layout, *sort_by] else spread
    counted = ordered.observe(written, F.count(F.lit(1)).alias("n"))
    writer = counted.write.partitionBy(*layout) if layout else counted.write
    writer.parquet(f"{path}/data/{ATTEMPT}={attempt}")  # a folder of its own, so that writers don't share a temporary one
    return written.get["n"]


def append_batch(
    rows: DataFrame,
    path: str,
    layout: list[str],
    sort_by: list[str] = (),
    batch: str | None = None,
    rollups: dict[str, Rollup] | None = None,
    parts: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> int:
    """Appends rows and returns how many; none if a batch of that name is stored already. `parts` makes the rows of rollups,
    for which the rows are read again."""
    ledger = Ledger(rows.sparkSession, path, rollups)
    if batch is not None and Ledger.exists(rows.sparkSession, path) and ledger.has(batch):
        return 0
    attempt = new_attempt()
    written = _write(rows, path, attempt, layout, sort_by)
    for name, part in (parts or {}).items():
        ledger.write_part(name, part(rows), attempt)
    return written if ledger.commit(attempt, batch) else 0


def append_batches(
    rows: DataFrame,
    number: str,
    path: str,
    names: dict[int, str],
    layout: list[str],
    sort_by: list[str] = (),
    rollups: dict[str, Rollup] | None = None,
    parts: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> None:
    """Appends several batches by one write, in the order of their numbers.

    The column `number` says to which batch of `names` a row belongs; it is not stored. Each batch has a commit of its own, with or
    without rows, and one of a name that is stored already is left out. Batches between two folds share an attempt and count
    together. `parts` makes the rows of rollups, given rows with an attempt column that they keep.
    """
    spark = rows.sparkSession
    ledger = Ledger(spark, path, rollups)
    while True:
        seen = ledger.log.newest()
        held = ledger.held(names.values()) if seen else set()
        new = [n for n in sorted(names) if names[n] not in held]
        if not new:
            return
        attempt, shared = new_attempt(), {}
        for i, n in enumerate(new):
            shared.setdefault(f"{attempt}-{(seen + i) // LG.FOLD}", []).append(n)
        named = F.lit(None).cast("string")
        for name, some in shared.items():
            named = F.when(F.col(number) >= some[0], F.lit(name)).otherwise(named)
        tagged = rows.where(F.col(number).isin(new)).withColumn(ATTEMPT, named).drop(number)
        # written apart from other writers, then moved to where a single batch would have been written
        draft = f"{path}/drafts/{attempt}"

        def write(what: DataFrame, name: str, columns: list[str], order: list[str] = (), draft: str = draft) -> None:
            spread = what.repartition(*columns).sortWithinPartitions(*columns, *order)
            spread.write.partitionBy(*columns).parquet(f"{draft}/{name}")

        write(tagged, "data", [ATTEMPT, *layout], sort_by)
        move_folders(spark, f"{draft}/data", f"{path}/data", f"{ATTEMPT}=")
        for name, part in (parts or {}).items():
            write(part(tagged), name, [ATTEMPT])
            move_folders(spark, f"{draft}/{name}", f"{path}/parts/{name}", f"{ATTEMPT}=", keep_prefix=False)
        for name, some in shared.items():
            seen = ledger.commit_together(name, {n: names[n] for n in some}, seen)
            if seen is None:  # another writer has stored some of these: those left are written anew
                break
        else:
            return


def append_bars(batch: DataFrame, path: str, ingested_at: Column) -> int:
    """Stores candles, first writer per stream and open time."""
    return insert_if_absent(batch, path, "market_data_raw", ingested_at)


def append_open_interest(batch: DataFrame, path: str, ingested_at: Column) -> int:
    """Stores open interest, first writer per series and open time."""
    return insert_if_absent(batch, path, "open_interest_history", ingested_at)


def append_funding(batch: DataFrame, path: str, ingested_at: Column) -> int:
    """Stores funding prints, first writer per market and funding time."""
    return insert_if_absent(batch, path, "funding_rate_history", ingested_at)


def append_long_short(batch: DataFrame, path: str, ingested_at: Column) -> int:
    """Stores account ratios, first writer per series and open time."""
    return insert_if_absent(batch, path, "long_short_ratio_history", ingested_at)


def append_taker(batch: DataFrame, path: str, ingested_at: Column) -> int:
    """Stores taker volumes, first writer per series and open time."""
    return insert_if_absent(batch, path, "taker_buy_sell_volume_history", ingested_at)


# --- plain appends ------------------------------------------------------------------------


def append_liquidations(rows: DataFrame, path: str, ingested_at: Column, batch: str | None = None) -> int:
    """Appends liquidation events; duplicates are kept, but a batch that is run again under its name is stored once.

    The rows are read twice, for the table and for its summary.
    """
    table = "liquidation_event"
    typed = rows.select(*_typed_columns(rows, table, ingested_at)).withColumn(DAY_COLUMN, F.to_date("liquidation_time"))
    order = [*C.MARKET_KEY, "liquidation_time"]
    return append_batch(typed, path, [DAY_COLUMN], order, batch, DAYS, {"days": _summary(table)})


def append_flushed_liquidations(rows: DataFrame, path: str, ingested_at: Column, names: dict[int, str], number: str = "flush") -> None:
    """Appends the events of several flushes, each as a batch of its own: `number` is a row's flush, `names` has all flushes."""
    table = "liquidation_event"
    typed = rows.select(*_typed_columns(rows, table, ingested_at), F.col(number).alias("_batch"))
    typed = typed.withColumn(DAY_COLUMN, F.to_date("liquidation_time"))
    order = [*C.MARKET_KEY, "liquidation_time"]

    def days(tagged: DataFrame) -> DataFrame:
        return SU.summarise(tagged, S.TIME_COLUMN[table], DATASET[table], also=[ATTEMPT])

    append_batches(typed, "_batch", path, names, [DAY_COLUMN], order, DAYS, {"days": days})


def append_quality_issues(issues: DataFrame, path: str, detected_at: Column, run_id: Column) -> int:
    """Appends quality issues with their detection time and run."""
    rows = conform(issues.withColumn("detected_at", detected_at).withColumn("run_id", run_id), "data_quality_issue")
    return append_batch(rows, path, ["issue_type"])


def append_run_log(
    results: DataFrame, path: str, started_at: Column, ended_at: Column, batch: str | None = None
) -> int:
    """Appends the final state of each job of a batch, one row per job."""
    rows = results.withColumn("dataset", F.col("source_dataset")) if "dataset" not in results.columns else results
    rows = rows if "run_id" in rows.columns else rows.withColumn("run_id", F.uuid())
    rows = conform(rows.withColumn("started_at", started_at).withColumn("ended_at", ended_at), "ingestion_run_log")
    return append_batch(rows.withColumn(DAY_COLUMN, F.to_date("started_at")), path, [DAY_COLUMN], batch=batch)


def latest_run_per_job(run_log: DataFrame, keys: list[str]) -> DataFrame:
    """The latest run of each job, as a grouped maximum. Runs that started together are told apart by status text."""
    values = [c for c in run_log.columns if c not in keys]
    return (
        run_log.groupBy(*keys)
        .agg(F.max_by(F.struct(*values), F.struct("started_at", "status")).alias("v"))
        .select(*keys, "v.*")
    )


# --- upserts ----------------------------------------------------------------------------------


def _snapshot(spark: SparkSession, path: str, table: str, number: int) -> DataFrame:
    if number == 0:
        return spark.createDataFrame([], S.schema_of(table))
    attempt = Ledger(spark, path).log.after(number - 1, number).first()["attempt"]
    return spark.read.schema(S.schema_of(table)).parquet(f"{path}/snapshots/{attempt}")


def read_snapshot(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The committed state of an upserted table (empty before the first write)."""
    return _snapshot(spark, path, table, Ledger(spark, path).log.newest())


def upsert(batch: DataFrame, path: str, table: str, key: list[str], order: list[str], updated_at: Column) -> None:
    """Last row per key over the stored state and the batch (by `order`); keys not in the batch stay as they are.

    If another writer commits meanwhile, the batch is merged again with what it left.
    """
    spark = batch.sparkSession
    ledger = Ledger(spark, path)
    fresh = batch.withColumn("updated_at", updated_at).withColumn("_in_batch", F.lit(1))
    values = [f.name for f in S.schema_of(table).fields if f.name not in key]
    while True:
        number, attempt = ledger.log.newest(), new_attempt()
        stored = _snapshot(spark, path, table, number).withColumn("_in_batch", F.lit(0))
        rows = stored.unionByName(fresh, allowMissingColumns=True)
        last = F.max_by(F.struct(*values), F.struct("_in_batch", *order)).alias("v")
        merged = rows.groupBy(*key).agg(last).select(*key, "v.*")
        conform(merged, table).write.parquet(f"{path}/snapshots/{attempt}")
        if ledger.commit(attempt, seen=number):
            return


def upsert_registry(markets: DataFrame, path: str, updated_at: Column, order: list[str]) -> None:
    """Lists markets as active; base and quote of known ones are replaced. Vanished markets are never deactivated."""
    rows = markets.select(*C.MARKET_KEY, "base_asset", "quote_asset", F.lit(True).alias("is_active"), *order)
    upsert(rows, path, "asset_registry", C.MARKET_KEY, order, updated_at)


def upsert_jobs(jobs: DataFrame, path: str, updated_at: Column, order: list[str]) -> None:
    """Writes seeded jobs by stream key. Seeding again without active=True deactivates jobs that were active."""
    carried = ["job_name", *C.STREAM_KEY, "fetch_mode", "start_time", "end_time", "is_active"]
    rows = jobs.select(*carried, F.lit(C.SEED_JOB_NOTE).alias("notes"), *[o for o in order if o not in carried])
    rows = rows.withColumn("job_id", F.sha1(F.concat_ws("|", *C.STREAM_KEY)))
    upsert(rows, path, "ingestion_job_config", C.STREAM_KEY, order, updated_at)


def listed_assets(spark: SparkSession, assets: list[str]) -> DataFrame:
    """Assets named on the command line with their 1-based position."""
    names = F.array(*[F.lit(a) for a in assets]) if assets else F.array().cast("array<string>")
    rows = spark.range(1).select(F.posexplode(names).alias("position", "base_asset"))
    return rows.select("base_asset", (F.col("position") + 1).cast("bigint").alias("position"))


def upsert_watchlist(assets: DataFrame, path: str, updated_at: Column) -> None:
    """Activates assets (base_asset, position) in upper case; a repeated asset takes its last position."""
    rows = assets.select(
        F.upper("base_asset").alias("base_asset"), F.col("position").alias("display_order"), F.lit(True).alias("is_active")
    )
    upsert(rows, path, "watchlist_asset", ["base_asset"], ["display_order"], updated_at)


# --- job scans -----------------------------------------------------------------------------------


def active_jobs(jobs: DataFrame, job_name: str | None = None) -> DataFrame:
    """Active jobs in name order, or the one with an exact name."""
    rows = jobs.where(F.col("is_active"))
    return (rows if job_name is None else rows.where(F.col("job_name") == job_name)).orderBy("job_name")


def job_lookup(jobs: DataFrame, job_name: str) -> DataFrame:
    """One active job by name. If there is none, the error names the active jobs."""
    found = active_jobs(jobs, job_name).limit(1)
    if not found.isEmpty():
        return found
    names = [r["job_name"] for r in active_jobs(jobs).select("job_name").collect()]
    if not names:
        raise LookupError(f"There is no job '{job_name}', nor any other active job.")
    raise LookupError(f"There is no active job '{job_name}'. Active jobs: {', '.join(names)}")


def watchlist_jobs(
    jobs: DataFrame,
    registry: DataFrame,
    assets: list[str],
    exchanges: list[str],
    intervals: list[str] | None = None,
    datasets: list[str] | None = None,
) -> DataFrame:
    """Active jobs of listed assets and exchanges. Whether the market itself is active does not matter here."""
    markets = registry.where(F.upper("base_asset").isin([a.upper() for a in assets])).select(*C.MARKET_KEY, "base_asset")
    rows = jobs.where(F.col("is_active") & F.col("exchange").isin(exchanges))
    if intervals:
        rows = rows.where(F.col("bar_interval").isin(intervals))
    if datasets:
        rows = rows.where(F.col("source_dataset").isin(datasets))
    return rows.join(markets, C.MARKET_KEY).orderBy("exchange", "base_asset", "source_dataset", "bar_interval", "symbol")
