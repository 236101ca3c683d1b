"""Streaming queries run to the end of their input, and the state they leave."""

from __future__ import annotations

import math
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import adapters, params, schemas
from tickloom.operators import buckets as bk
from tickloom.operators.clean import clean_events
from tickloom.registry import Query
from tickloom.registry.history import ORACLES as HISTORY_SQL
from tickloom.registry.ingest import raw_records
from tickloom.registry.recent import ORACLES as RECENT_SQL
from tickloom.registry.recent import (
    USER_SETTINGS,
    _BUCKET_COLUMNS,
    _BUCKET_ROLLUP,
    _sql_buckets,
    _sql_recent,
    _USER_HISTORY,
    _USERS,
    _user_baselines,
)
from tickloom.registry.shared import (
    HOUR,
    SQL_EVENTS,
    SQL_SCORE_COLUMNS,
    SQL_WINDOW_COLUMNS,
    events,
    rounded,
    sql_scores,
    sql_windows,
    user_events,
)
from tickloom.session import materialise, scratch_path
from tickloom.sources.events import read_event_stream, read_events
from tickloom.sources.messages import decode_records, read_record_files
from tickloom.sinks.tables import write_baselines_json
from tickloom.streaming import sinks
from tickloom.streaming.aggregates import stream_dedupe, stream_windows
from tickloom.sources.baselines import baseline_stamp, read_baselines
from tickloom.streaming.hybrid import HybridView, Refreshing, start
from tickloom.sources.logs import read_log
from tickloom.streaming.runs import RunLog, observe_latency, run_totals
from tickloom.streaming.serving import ServingRefresh
from tickloom.streaming.state import (
    WINDOW,
    recent_bucket_windows,
    recent_record_windows,
    stored_buckets,
    stored_checkpoints,
)
from tickloom.streaming.tables import KeyedTable, read_changes, write_changes

FILES = 4
# The test files arrive in any order over a month, so nothing may count as late.
NEVER_LATE = "90 days"
LATENESS = "7 days"
USER_BUCKET_MS = USER_SETTINGS.bucket_ms
OBSERVED_AT = 1_800_000_000_000
# Longer than two runs over the test tables take, so that deliveries come in time at the first go.
RETENTION_SECONDS = 44
# Every symbol with a baseline is scored in its last batch, whatever earlier batches held.
STREAM_SETTINGS = params.Params(
    window="1 day", min_liquidity=0.0, min_records=1, bucket_ms=USER_BUCKET_MS
)


def _staged(spark: SparkSession, trades: DataFrame, files: int = FILES) -> str:
    """Folder of JSON files that each hold a slice of time."""
    path = scratch_path(spark, "arriving")
    trades.repartitionByRange(files, "event_time").write.json(path)
    return path


def _stream(spark: SparkSession, trades: DataFrame) -> DataFrame:
    return read_event_stream(spark, _staged(spark, trades), max_files_per_trigger=1)


# Milliseconds of each micro-batch run so far, for the benchmark.
DURATIONS: list[int] = []


def _finish(query) -> None:
    query.awaitTermination()
    DURATIONS.extend(p["durationMs"]["triggerExecution"] for p in query.recentProgress)


def windows_of_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly windows kept up to date by a stream, the last version of each."""
    arriving = clean_events(_stream(spark, events(spark, folder)))
    windows = stream_windows(arriving, HOUR, NEVER_LATE)
    path = scratch_path(spark, "changes")
    query = (
        windows.writeStream.outputMode("update")
        .foreachBatch(lambda changed, batch_id: write_changes(changed, batch_id, path))
        .option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    _finish(query)
    return rounded(read_changes(spark, path, ["symbol", "window_start"]))


def late_rows_of_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Every tenth trade arrives after all others: windows closed by then do without it."""
    trades = events(spark, folder)
    part = F.pmod("trade_id", F.lit(10))
    path = scratch_path(spark, "arriving")
    # Files are read in the order they were written, those of one arrival in one micro-batch, which
    # drops what was late before the one that precedes it.
    for arrival, rows in enumerate((part > 1, part == 1, part == 0)):
        trades.where(rows).repartition(FILES).write.json(f"{path}/arrival={arrival}")
    arriving = clean_events(read_event_stream(spark, path, max_files_per_trigger=FILES))
    changes = scratch_path(spark, "changes")
    _finish(
        stream_windows(arriving, HOUR, LATENESS)
        .writeStream.outputMode("update")
        .foreachBatch(lambda changed, batch_id: write_changes(changed, batch_id, changes))
        .option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    return rounded(read_changes(spark, changes, ["symbol", "window_start"]))


def _expiry_run(spark: SparkSession, trades: DataFrame, retention_seconds: int) -> tuple[str, float]:
    """Checkpoint after the deliveries, and the retention beyond which each came before state of the
    one before it expired."""
    path, checkpoint = scratch_path(spark, "arriving"), scratch_path(spark, "checkpoint")
    # the time of a micro-batch, by which state expires, lies between its stream's start and its step
    earliest, latest = [], []

    def step(batch: DataFrame, batch_id: int) -> None:
        latest[-1] = time.time()
        _nowhere(batch, batch_id)

    needed = 0.0
    for third, after in enumerate((0.0, retention_seconds / 3, retention_seconds + 0.1)):
        arrived = trades.where(F.col("trade_id") % 3 == third)
        arrived.write.json(f"{path}/third={third}")
        if third:
            time.sleep(max(0.0, latest[0] + after - time.time()))
        earliest.append(time.time())
        latest.append(time.time())
        windows = recent_bucket_windows(
            read_event_stream(spark, path), USER_SETTINGS.window, USER_BUCKET_MS, retention_seconds
        )
        _finish(start(windows, step, checkpoint))
        if third:
            needed = max(needed, latest[third] - earliest[third - 1])
        if needed >= retention_seconds:
            break
    return checkpoint, needed


def expiry_of_state(spark: SparkSession, folder: str) -> DataFrame:
    """A third of the trades arrives, the next before state of the first expires, the last after that.
    The state holds what the first left only of users whom the second touched, and all of the others.

    State expires by the clock: where a delivery took too long, all come again under a longer retention.
    """
    trades = user_events(spark, folder)
    retention_seconds, needed = 0, float(RETENTION_SECONDS)
    while needed >= retention_seconds:
        retention_seconds = max(2 * retention_seconds, math.ceil(needed) + 1)
        checkpoint, needed = _expiry_run(spark, trades, retention_seconds)
    held = stored_buckets(spark, checkpoint)
    return held.groupBy("symbol").agg(F.max("last_event_time").alias("newest"))


def _nowhere(batch: DataFrame, batch_id: int) -> None:
    batch.write.format("noop").mode("overwrite").save()


def _view_of(spark: SparkSession, baselines: Refreshing) -> HybridView:
    path = scratch_path(spark, "view")
    return HybridView(spark, path, baselines, STREAM_SETTINGS, clock_ms=lambda: OBSERVED_AT)


def baseline_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """A batch job writes baselines over those that a stream uses: first of some users, then of all.
    The stream takes the new ones 300 seconds after it read the first."""
    trades, rows = _user_baselines(spark, folder)
    stats = materialise(rows, "baselines")
    published, clock = scratch_path(spark, "published"), [0.0]
    refreshing = Refreshing(
        lambda: read_baselines(spark, published),
        300,
        lambda: clock[0],
        lambda: baseline_stamp(spark, published),
    )
    view = _view_of(spark, refreshing)
    path, checkpoint = scratch_path(spark, "arriving"), scratch_path(spark, "checkpoint")
    early = None
    for delivery, second in enumerate((0.0, 299.0, 300.0)):
        known = stats if delivery else stats.where(F.pmod(F.length("symbol"), F.lit(2)) == 0)
        write_baselines_json(known, published)
        clock[0] = second
        trades.write.json(f"{path}/delivery={delivery}")
        windows = recent_record_windows(read_event_stream(spark, path), STREAM_SETTINGS.window)
        _finish(start(windows, view, checkpoint))
        if delivery == 1:
            served = view.latest.current().select("symbol", F.lit(1).alias("early"))
            early = materialise(served, "early")
    served = view.latest.current().join(early, "symbol", "left")
    return rounded(served.withColumn("early", F.col("early").isNotNull()))


def serving_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The trending list that a stream publishes as its document, read back."""
    trades, rows = _user_baselines(spark, folder)
    stats = materialise(rows, "baselines")
    path = scratch_path(spark, "serving")
    refresh = ServingRefresh(spark, path, _view_of(spark, Refreshing(lambda: stats)))
    windows = recent_record_windows(_stream(spark, trades), STREAM_SETTINGS.window)
    _finish(start(windows, refresh, scratch_path(spark, "checkpoint")))
    lists = T.StructType([T.StructField("trending", T.ArrayType(schemas.SCORE))])
    document = refresh.document().select(F.from_json("value", lists).alias("d"))
    listed = document.select(F.posexplode("d.trending").alias("at", "row"))
    return rounded(listed.select((F.col("at") + 1).cast("long").alias("place"), "row.*"))


def dedup_of_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Dear trades arrive twice, views have no id: copies go, rows without id all stay."""
    trades = events(spark, folder).withColumn(
        "trade_id", F.when(F.col("base_asset") != "VIEW", F.col("trade_id"))
    )
    twice = trades.unionByName(trades.where(F.col("last_price") >= 50))
    unique = stream_dedupe(clean_events(_stream(spark, twice)), NEVER_LATE)
    path = scratch_path(spark, "unique")
    _finish(
        unique.select(*schemas.EVENT_COLUMNS)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start(path)
    )
    stored = spark.read.schema(schemas.EVENT).parquet(path)
    return rounded(stored.select("symbol", "event_time", "last_price", "trade_id"))


def sliding_of_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Recent day of each user out of its events; every trade arrives twice."""
    trades = user_events(spark, folder)
    latest = KeyedTable(spark, scratch_path(spark, "latest"), WINDOW)
    windows = recent_record_windows(_stream(spark, trades.unionByName(trades)), USER_SETTINGS.window)
    _finish(start(windows, latest.merge, scratch_path(spark, "checkpoint")))
    return rounded(latest.current().withColumnRenamed("records", "record_count"))


def _records_stream(spark: SparkSession, trades: DataFrame, copies: int) -> DataFrame:
    """Base64 records of the trades as a stream; each copy is delivered in files of its own."""
    path = scratch_path(spark, "records")
    for copy in range(copies):
        (
            raw_records(trades.repartitionByRange(FILES, "event_time"))
            .write.option("compression", "gzip")
            .json(f"{path}/delivery={copy}")
        )
    raw = read_record_files(spark, path, max_files_per_trigger=2)
    return decode_records(raw)


def _bucket_state(spark: SparkSession, folder: str, copies: int) -> str:
    """Checkpoint of a stream of records that has come to its end."""
    checkpoint = scratch_path(spark, "checkpoint")
    records = _records_stream(spark, user_events(spark, folder), copies)
    windows = recent_bucket_windows(records, USER_SETTINGS.window, USER_BUCKET_MS)
    _finish(start(windows, _nowhere, checkpoint))
    return checkpoint


def _recent_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    held = materialise(stored_buckets(spark, checkpoint), "held")
    return rounded(bk.retain_recent(held, params.duration_ms(USER_SETTINGS.window)))


def buckets_of_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The buckets that the stream's state holds, read from the state itself."""
    return _recent_state(spark, _bucket_state(spark, folder, copies=1))


def replay_of_stream(spark: SparkSession, folder: str) -> DataFrame:
    """All records are delivered a second time; sequence checkpoints make that a no-op."""
    return _recent_state(spark, _bucket_state(spark, folder, copies=2))


def checkpoints_of_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The sequences that the stream's state has reached, read from the state itself."""
    return stored_checkpoints(spark, _bucket_state(spark, folder, copies=1))


def hybrid_of_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Records to stored hybrid rows in one stream: decode, state, baseline join, score, upsert."""
    trades, rows = _user_baselines(spark, folder)
    stats = materialise(rows, "baselines")
    view = _view_of(spark, Refreshing(lambda: stats))
    windows = recent_bucket_windows(
        _records_stream(spark, trades, 1), STREAM_SETTINGS.window, STREAM_SETTINGS.bucket_ms
    )
    _finish(start(windows, view, scratch_path(spark, "checkpoint")))
    return rounded(view.latest.current())


def run_of_stream(spark: SparkSession, folder: str) -> DataFrame:
    """What Spark reports of a stream over the trades, by way of its log."""
    arriving = clean_events(_stream(spark, events(spark, folder)))
    seen = observe_latency(arriving, F.col("ingest_time") - F.col("event_time"))
    log, path = RunLog(), scratch_path(spark, "runs")
    spark.streams.addListener(log)
    try:
        query = start(seen, _nowhere, scratch_path(spark, "checkpoint"))
        _finish(query)
        log.wait(str(query.runId))
    finally:
        spark.streams.removeListener(log)
    log.write(spark, path)
    totals = run_totals(read_log(spark, path, schemas.BATCH_LOG).where(F.col("run_id") == str(query.runId)))
    return totals.select(
        "sent_records",
        "failed_records",
        "successful_records",
        "minimum_latency_ms",
        "maximum_latency_ms",
        (F.col("batches") >= 1).alias("has_batches"),
        (F.col("achieved_throughput") > 0).alias("has_rate"),
    )


def archive_of_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Trades archived by date, hour and symbol, scanned again."""
    path = scratch_path(spark, "archive")
    arriving = read_event_stream(spark, _staged(spark, events(spark, folder)))
    _finish(
        sinks.archive_events(
            arriving, path, scratch_path(spark, "checkpoint"), every=None, writers=1
        )
    )
    columns = [name for name in schemas.EVENT_COLUMNS if name not in ("schema_version", "event_type")]
    return rounded(read_events(spark, f"{path}/date=*").select(*columns))


def json_lines_of_stream(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "json-lines")
    _finish(
        sinks.append_json_lines(
            _stream(spark, events(spark, folder)), path, scratch_path(spark, "checkpoint")
        )
    )
    columns = [name for name in schemas.EVENT_COLUMNS if name not in ("schema_version", "event_type")]
    return rounded(spark.read.schema(schemas.EVENT).json(path).select(*columns))


QUERIES: dict[str, Query] = {
    "stream_windows": windows_of_stream,
    "stream_late": late_rows_of_stream,
    "stream_expiry": expiry_of_state,
    "baseline_refresh": baseline_refresh,
    "serving_refresh": serving_refresh,
    "stream_dedup": dedup_of_stream,
    "stream_sliding": sliding_of_stream,
    "stream_buckets": buckets_of_stream,
    "replay_idempotent": replay_of_stream,
    "stream_checkpoints": checkpoints_of_stream,
    "stream_hybrid": hybrid_of_stream,
    "stream_run_log": run_of_stream,
    "stream_archive": archive_of_stream,
    "stream_json_lines": json_lines_of_stream,
}

_EVENT_COLUMNS = """symbol, base_asset, event_time, round(last_price, 6) AS last_price,
  round(quote_volume, 6) AS quote_volume, trade_count, ingest_time, trade_id"""
_RECENT_BUCKETS = f"""WITH {_USERS}, {_sql_buckets("u", USER_BUCKET_MS)}
SELECT {_BUCKET_COLUMNS}
FROM (SELECT k.*, max(last_event_time) OVER (PARTITION BY symbol) AS newest FROM k)
WHERE last_event_time >= newest - 86400000"""

ORACLES: dict[str, str] = {
    "stream_windows": HISTORY_SQL["event_windows"],
    "stream_late": f"""WITH {SQL_EVENTS.replace("m AS (", "e AS (", 1)},
m AS (SELECT * FROM e WHERE trade_id % 10 <> 0
      OR event_time - event_time % 3600000 + 3600000
         > (SELECT max(event_time) FROM e WHERE trade_id % 10 > 1) - 604800000),
{sql_windows()}
SELECT {SQL_WINDOW_COLUMNS} FROM w""",
    "stream_expiry": f"""WITH {_USERS},
t AS (SELECT symbol, max(event_time) FILTER (trade_id % 3 = 0) AS a,
        max(event_time) FILTER (trade_id % 3 = 1) AS b, max(event_time) FILTER (trade_id % 3 = 2) AS c
      FROM u GROUP BY symbol)
SELECT symbol, greatest(CASE WHEN b IS NOT NULL THEN a END, b, c) AS newest
FROM t WHERE b IS NOT NULL OR c IS NOT NULL""",
    "baseline_refresh": f"""{_USER_HISTORY}, {_sql_recent("u", 86_400_000, 1)},
{sql_scores("r", str(OBSERVED_AT), min_liquidity=0.0)}
SELECT {SQL_SCORE_COLUMNS},
  CAST({OBSERVED_AT // 1000 + STREAM_SETTINGS.state_retention_seconds} AS BIGINT) AS expires_at,
  length(symbol) % 2 = 0 AS early
FROM s""",
    "serving_refresh": f"""{_USER_HISTORY}, {_sql_recent("u", 86_400_000, 1)},
{sql_scores("r", str(OBSERVED_AT), min_liquidity=0.0)}
SELECT {SQL_SCORE_COLUMNS}, row_number() OVER (ORDER BY s.trend_score DESC, symbol) AS place
FROM s QUALIFY place <= 10""",
    "stream_dedup": f"""WITH {SQL_EVENTS}
SELECT symbol, event_time, round(last_price, 6) AS last_price,
  CASE WHEN base_asset <> 'VIEW' THEN trade_id END AS trade_id
FROM (SELECT * FROM m UNION ALL SELECT * FROM m WHERE base_asset = 'VIEW' AND last_price >= 50)""",
    "stream_sliding": RECENT_SQL["sliding_latest"],
    "stream_buckets": _RECENT_BUCKETS,
    "replay_idempotent": _RECENT_BUCKETS,
    "stream_checkpoints": f"""WITH {_USERS},
d AS (SELECT *, CASE WHEN last_price < 200 THEN 'shard-' || (event_time // 60000) % 4 ELSE 'unknown' END
        AS shard FROM u)
SELECT symbol, shard, CAST(max(trade_id + 1) AS VARCHAR) AS sequence FROM d GROUP BY symbol, shard""",
    "stream_hybrid": f"""{_USER_HISTORY}, {_BUCKET_ROLLUP.replace("HAVING count(*) >= 2", "")},
{sql_scores("r", str(OBSERVED_AT), min_liquidity=0.0)}
SELECT {SQL_SCORE_COLUMNS},
  CAST({OBSERVED_AT // 1000 + STREAM_SETTINGS.state_retention_seconds} AS BIGINT) AS expires_at
FROM s""",
    "stream_run_log": f"""WITH {SQL_EVENTS}
SELECT count(*) AS sent_records, 0::BIGINT AS failed_records, count(*) AS successful_records,
  CAST(min(ingest_time - event_time) AS DOUBLE) AS minimum_latency_ms,
  CAST(max(ingest_time - event_time) AS DOUBLE) AS maximum_latency_ms,
  true AS has_batches, true AS has_rate
FROM m""",
    "stream_archive": f"WITH {SQL_EVENTS} SELECT {_EVENT_COLUMNS} FROM m",
    "stream_json_lines": f"WITH {SQL_EVENTS} SELECT {_EVENT_COLUMNS} FROM m",
}
