"""Published tables and documents, written and read back."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import adapters, schemas
from tickloom.operators import daily
from tickloom.operators.clean import clean_events
from tickloom.operators.sliding import latest_sliding
from tickloom.operators.windows import event_windows
from tickloom.plans import hybrid, views
from tickloom.plans.batch import run_batch
from tickloom.registry import Query
from tickloom.registry.recent import ORACLES as RECENT_SQL
from tickloom.registry.recent import _sensitive_users, _sql_recent, _user_baselines
from tickloom.registry.history import ORACLES as HISTORY_SQL
from tickloom.registry.shared import (
    HOUR,
    SQL_BASELINE_COLUMNS,
    SQL_EVENTS,
    SQL_HISTORY,
    UPDATED_AT,
    events,
    hourly,
    hourly_baselines,
    rounded,
    user_events,
)
from tickloom.session import materialise, scratch_path
from tickloom.sinks import tables
from tickloom.sources import archive
from tickloom.sources.baselines import read_baselines
from tickloom.sources import events as event_files

# Midnight of 2024-01-06.
CLICKS_END = 1_704_499_200_000
_EVENT_ONLY = ("schema_version", "event_type", "event_timestamp")


def sink_windows(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "windows-by-symbol")
    tables.write_windows(hourly(spark, folder), path)
    return rounded(tables.read_windows(spark, path))


def sink_baselines(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "baselines")
    tables.write_baselines(hourly_baselines(spark, folder), path)
    return rounded(spark.read.parquet(path))


def load_baselines(spark: SparkSession, folder: str) -> DataFrame:
    """Baselines of users through one JSON Lines part."""
    path = scratch_path(spark, "baselines-json")
    tables.write_baselines_json(_user_baselines(spark, folder)[1], path)
    return rounded(read_baselines(spark, path))


def load_baselines_envelope(spark: SparkSession, folder: str) -> DataFrame:
    """Baselines of users through one JSON document."""
    path = scratch_path(spark, "baselines-envelope")
    tables.write_baseline_envelope(_user_baselines(spark, folder)[1], path, UPDATED_AT)
    return rounded(read_baselines(spark, path))


def load_baselines_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """Baselines of users, some in JSON Lines parts and the others in one document, read together."""
    path = scratch_path(spark, "baselines-mixed")
    rows = _user_baselines(spark, folder)[1]
    odd = F.pmod(F.xxhash64("symbol"), F.lit(2)) == 1
    tables.write_baselines_json(rows.where(odd), f"{path}/lines")
    tables.write_baseline_envelope(rows.where(~odd), f"{path}/document", UPDATED_AT)
    return rounded(read_baselines(spark, f"{path}/*"))


def backfill_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Days of a CSV archive filled in two runs that overlap; the second leaves the first's alone."""
    path = scratch_path(spark, "archive")
    trades = events(spark, folder)
    day = F.to_date(F.timestamp_millis("event_time"))
    (
        trades.select(
            F.col("trade_id").alias("aggregate_id"),
            F.col("last_price").alias("price"),
            (F.col("quote_volume") / F.col("last_price")).alias("quantity"),
            F.lit(1).alias("first_trade_id"),
            F.lit(1).alias("last_trade_id"),
            F.col("event_time").alias("time"),
            F.lit("True").alias("maker"),
            F.lit("True").alias("best"),
            day.alias("day"),
            F.col("symbol").alias("symbol"),
        )
        .write.partitionBy("day", "symbol")
        .csv(f"{path}/csv")
    )
    symbols = trades.select("symbol").distinct()
    for last in (date(2024, 1, 4), date(2024, 1, 20)):
        there = archive.existing_outputs(spark, f"{path}/events")
        manifest = archive.backfill_manifest(symbols, date(2024, 1, 2), last, there)
        archive.backfill(spark, f"{path}/csv", f"{path}/events", materialise(manifest, "manifest"))
    filled = clean_events(event_files.read_events(spark, f"{path}/events"))
    return rounded(filled.select("symbol", "event_time", "last_price", "quote_volume", "trade_id"))


def archive_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """Backfill files per symbol and day, scanned recursively."""
    path = scratch_path(spark, "events-by-day")
    tables.write_events_by_day(events(spark, folder), path)
    cleaned = clean_events(event_files.read_events(spark, path))
    return rounded(cleaned.drop(*_EVENT_ONLY))


def scan_strict(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "json-lines")
    tables.write_json_lines(events(spark, folder), path)
    cleaned = clean_events(event_files.read_events_strict(spark, path), lenient=True)
    return rounded(cleaned.drop(*_EVENT_ONLY))


def _json_archive(spark: SparkSession, trades: DataFrame) -> str:
    path = scratch_path(spark, "json-archive")
    tables.write_json_lines(trades, path)
    return path


def full_history_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The whole batch job from JSON Lines to published baselines."""
    out = scratch_path(spark, "published")
    run_batch(
        spark,
        _json_archive(spark, adapters.market_events(spark, folder)),
        f"{out}/baselines",
        UPDATED_AT,
        json_output=f"{out}/baselines-json",
        batch_view_output=f"{out}/windows",
        window=HOUR,
    )
    return rounded(read_baselines(spark, f"{out}/baselines-json"))


def batch_deduped(spark: SparkSession, folder: str) -> DataFrame:
    """The batch job over an archive that holds a third of its trades twice."""
    out = scratch_path(spark, "published")
    trades = adapters.market_events(spark, folder)
    twice = trades.unionByName(trades.where(F.pmod("trade_id", F.lit(3)) == 0))
    run_batch(
        spark, _json_archive(spark, twice), f"{out}/baselines", UPDATED_AT, window=HOUR, dedupe=True
    )
    return rounded(spark.read.parquet(f"{out}/baselines").select(*schemas.BASELINE.fieldNames()))


def _event_table(spark: SparkSession, folder: str) -> str:
    """The trades as a table by date and symbol, by way of the raw archive, a day at a time anew."""
    path = scratch_path(spark, "event-table")
    raw = f"{path}/raw"
    trades = events(spark, folder)
    day = F.to_date(F.timestamp_millis("event_time"))
    columns = [*schemas.EVENT_COLUMNS, day.alias("date"), F.lit("00").alias("hour")]
    trades.select(*columns).write.partitionBy("date", "hour", "symbol").json(raw)
    middle = date(2024, 1, 15)
    for part in (
        event_files.read_archived_events(spark, raw, until=middle),
        event_files.read_archived_events(spark, raw, since=middle),
    ):
        tables.write_event_table(part, f"{path}/table")
    return f"{path}/table"


def event_table_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The batch job over a Parquet table of events."""
    out = scratch_path(spark, "published")
    source = _event_table(spark, folder)
    run_batch(spark, source, f"{out}/baselines", UPDATED_AT, window=HOUR, event_table=True)
    return rounded(spark.read.parquet(f"{out}/baselines").select(*schemas.BASELINE.fieldNames()))


def incremental_baselines(spark: SparkSession, folder: str) -> DataFrame:
    """Baselines merged out of daily states. The newest day comes in two parts: with the second, that
    day alone is read again. ``median_close`` tells whether the sketch's median has the rank it states."""
    trades = events(spark, folder)
    day = F.to_date(F.timestamp_millis("event_time"))
    first, last = trades.select(day.alias("d")).agg(F.min("d"), F.max("d")).first()
    table, states = scratch_path(spark, "event-table"), scratch_path(spark, "daily-states")
    tables.write_event_table(trades.where((day < last) | (F.col("trade_id") % 2 == 0)), table)
    daily.update_days(spark, table, states, first, last, HOUR)
    tables.write_event_table(trades.where(day == last), table)
    daily.update_days(spark, table, states, last, last, HOUR)
    rows = materialise(daily.merged_baselines(spark.read.parquet(states), UPDATED_AT), "merged")
    volume = F.col("quote_volume_5m")
    middle = F.col("median_quote_volume_5m")
    ranks = (
        hourly(spark, folder)
        .join(rows.select("symbol", middle), "symbol")
        .groupBy("symbol")
        .agg(F.avg((volume < middle).cast("int")).alias("below"), F.avg((volume <= middle).cast("int")).alias("upto"))
    )
    error = daily.MEDIAN_RANK_ERROR
    close = (F.col("below") <= 0.5 + error) & (F.col("upto") >= 0.5 - error)
    checked = rows.drop("median_quote_volume_5m").join(ranks, "symbol").withColumn("median_close", close)
    return rounded(checked.drop("below", "upto"))


def event_table_recent(spark: SparkSession, folder: str) -> DataFrame:
    """The newest day of each symbol out of the table by date and symbol, where clicks end early: only
    the days next to a symbol's last trade are opened."""
    quiet = (F.col("symbol") == "CLICKUSDT") & (F.col("event_time") >= CLICKS_END)
    table = scratch_path(spark, "event-table")
    tables.write_event_table(events(spark, folder).where(~quiet), table)
    return rounded(latest_sliding(event_files.read_newest_days(spark, table), "1 day", 1))


def event_table_days(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of two symbols over ten days; only their folders are opened."""
    rows = event_files.read_event_table(
        spark,
        _event_table(spark, folder),
        date(2024, 1, 10),
        date(2024, 1, 19),
        ["CLICKUSDT", "VIEWUSDT"],
    )
    return rounded(
        rows.groupBy("symbol").agg(
            F.count("*").alias("trades"),
            F.sum("quote_volume").alias("volume"),
            F.min("event_time").alias("first_time"),
            F.max("trade_id").alias("newest_id"),
        )
    )


def catalog_market_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The summary view in SQL over a catalog table on the JSON archive."""
    name = f"raw_market_events_{uuid.uuid4().hex}"
    event_files.create_events_table(spark, _json_archive(spark, adapters.market_events(spark, folder)), name)
    view = f"market_summary_{uuid.uuid4().hex}"
    views.market_summary(spark.table(name)).createOrReplaceTempView(view)
    return rounded(spark.sql(f"SELECT * FROM {view}"))


def catalog_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Windows per symbol in SQL over a partitioned catalog table."""
    path = scratch_path(spark, "windows-by-symbol")
    tables.write_windows(hourly(spark, folder), path)
    name = f"batch_windows_{uuid.uuid4().hex}"
    event_files.create_windows_table(spark, path, name)
    return spark.sql(
        f"""SELECT symbol, count(*) AS windows, max(window_end) AS newest,
                   round(sum(quote_volume_5m), 4) AS volume
            FROM {name} GROUP BY symbol"""
    )


def view_trending(spark: SparkSession, folder: str) -> DataFrame:
    """The trend view by its published name."""
    views.register_views(spark, events(spark, folder), hourly(spark, folder))
    return rounded(spark.sql("SELECT * FROM trending_coins"))


def serving_document(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshot document of both lists, parsed again."""
    trending, spikes = hybrid.serving_views(_sensitive_users(spark, folder))
    document = tables.snapshot_document(trending, spikes)
    entry = T.ArrayType(schemas.SCORE)
    parsed = document.select(
        F.from_json(
            "value", T.StructType([T.StructField("trending", entry), T.StructField("spikes", entry)])
        ).alias("lists")
    )
    both = None
    for name, label in (("trending", "trend"), ("spikes", "spike")):
        listed = parsed.select(F.posexplode(f"lists.{name}").alias("position", "row")).select(
            "row.*",
            (F.col("position") + 1).cast("long").alias("place"),
            F.lit(label).alias("list"),
        )
        both = listed if both is None else both.unionByName(listed)
    return rounded(both)


def sink_metrics_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Daily windows of users as a CSV log with a heading."""
    trades = user_events(spark, folder)
    daily = event_windows(trades, "1 day")
    path = scratch_path(spark, "log")
    tables.write_log(daily, path)
    log = spark.read.schema(daily.schema).option("header", "true").csv(path)
    return rounded(log)


QUERIES: dict[str, Query] = {
    "sink_windows": sink_windows,
    "sink_baselines": sink_baselines,
    "load_baselines": load_baselines,
    "load_baselines_envelope": load_baselines_envelope,
    "load_baselines_mixed": load_baselines_mixed,
    "backfill_incremental": backfill_incremental,
    "batch_deduped": batch_deduped,
    "event_table_batch": event_table_batch,
    "event_table_days": event_table_days,
    "event_table_recent": event_table_recent,
    "incremental_baselines": incremental_baselines,
    "archive_by_day": archive_by_day,
    "scan_strict": scan_strict,
    "full_history_batch": full_history_batch,
    "catalog_market_summary": catalog_market_summary,
    "catalog_windows": catalog_windows,
    "view_trending": view_trending,
    "serving_document": serving_document,
    "sink_metrics_csv": sink_metrics_csv,
}

_EVENT_COLUMNS = """symbol, base_asset, event_time, round(last_price, 6) AS last_price,
  round(quote_volume, 6) AS quote_volume, trade_count, ingest_time, trade_id"""

ORACLES: dict[str, str] = {
    "sink_windows": HISTORY_SQL["event_windows"],
    "sink_baselines": HISTORY_SQL["baselines"],
    "load_baselines": HISTORY_SQL["user_baselines"],
    "load_baselines_envelope": HISTORY_SQL["user_baselines"],
    "load_baselines_mixed": HISTORY_SQL["user_baselines"],
    "backfill_incremental": f"""WITH {SQL_EVENTS}
SELECT symbol, event_time, round(last_price, 6) AS last_price, round(quote_volume, 6) AS quote_volume,
  trade_id
FROM m WHERE make_timestamp(event_time * 1000)::DATE BETWEEN DATE '2024-01-02' AND DATE '2024-01-20'""",
    "event_table_batch": f"{SQL_HISTORY} SELECT {SQL_BASELINE_COLUMNS} FROM b",
    "event_table_days": f"""WITH {SQL_EVENTS}
SELECT symbol, count(*) AS trades, round(sum(quote_volume), 6) AS volume,
  min(event_time) AS first_time, max(trade_id) AS newest_id
FROM m WHERE symbol IN ('CLICKUSDT', 'VIEWUSDT')
  AND make_timestamp(event_time * 1000)::DATE BETWEEN DATE '2024-01-10' AND DATE '2024-01-19'
GROUP BY symbol""",
    "event_table_recent": f"""WITH {SQL_EVENTS},
q AS (SELECT * FROM m WHERE symbol <> 'CLICKUSDT' OR event_time < {CLICKS_END}), {_sql_recent("q", 86_400_000, 1)}
SELECT symbol, round(start_price, 6) AS start_price, round(end_price, 6) AS end_price,
  round(quote_volume_5m, 6) AS quote_volume_5m, trade_count_5m, record_count, window_start,
  window_end FROM r""",
    "incremental_baselines": f"""{SQL_HISTORY}
SELECT * EXCLUDE (median_quote_volume_5m), true AS median_close FROM (SELECT {SQL_BASELINE_COLUMNS} FROM b)""",
    "batch_deduped": f"{SQL_HISTORY} SELECT {SQL_BASELINE_COLUMNS} FROM b",
    "archive_by_day": f"WITH {SQL_EVENTS} SELECT {_EVENT_COLUMNS} FROM m",
    "scan_strict": f"WITH {SQL_EVENTS} SELECT {_EVENT_COLUMNS} FROM m",
    "full_history_batch": f"{SQL_HISTORY} SELECT {SQL_BASELINE_COLUMNS} FROM b",
    "catalog_market_summary": HISTORY_SQL["market_summary"],
    "catalog_windows": f"""{SQL_HISTORY}
SELECT symbol, count(*) AS windows, max(window_end) AS newest,
  round(sum(quote_volume_5m), 4) AS volume
FROM w GROUP BY symbol""",
    "view_trending": HISTORY_SQL["trending_latest"],
    "serving_document": RECENT_SQL["serving_top_lists"],
    "sink_metrics_csv": HISTORY_SQL["user_windows"],
}
