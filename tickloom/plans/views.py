"""The four published views over the event archive and the window table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import events as fn
from tickloom.functions import scoring
from tickloom.operators.baselines import history_columns
from tickloom.operators.latest import latest_rows
from tickloom.operators.ranking import live_rank
from tickloom.session import materialise

# Fixed value: |z| from which the history view reports a move.
ABNORMAL_ZSCORE = 3.0

_RETURN_AND_VOLUME = ("return_5m", "quote_volume_5m")


def latest_market_prices(events: DataFrame) -> DataFrame:
    """Newest price of every symbol with its ingestion latency."""
    priced = events.where(F.col("symbol").isNotNull() & (F.col("last_price") > 0))
    newest = latest_rows(priced, ("last_price", "quote_volume", "event_time", "ingest_time"))
    return newest.select(
        "symbol",
        fn.base_asset("symbol").alias("base_asset"),
        "last_price",
        "quote_volume",
        F.timestamp_millis("event_time").alias("event_timestamp"),
        scoring.delay_ms(F.col("ingest_time"), F.col("event_time")).alias("ingestion_latency_ms"),
    )


def market_summary(events: DataFrame) -> DataFrame:
    """Totals per symbol over the whole archive; the latency maximum is not floored."""
    totals = (
        events.where(F.col("symbol").isNotNull())
        .groupBy("symbol")
        .agg(
            F.count("*").alias("event_count"),
            F.min("event_time").alias("first_time"),
            F.max("event_time").alias("latest_time"),
            F.sum("quote_volume").alias("total_quote_volume"),
            F.avg("last_price").alias("average_trade_price"),
            F.max(F.col("ingest_time") - F.col("event_time")).alias("maximum_ingestion_latency_ms"),
        )
    )
    return totals.select(
        "symbol",
        "event_count",
        F.timestamp_millis("first_time").alias("first_event_timestamp"),
        F.timestamp_millis("latest_time").alias("latest_event_timestamp"),
        "total_quote_volume",
        "average_trade_price",
        "maximum_ingestion_latency_ms",
    )


def history_and_latest(windows: DataFrame) -> DataFrame:
    """Per symbol its history statistics next to its own newest window.

    One aggregation instead of a self-join: every picked column is a primitive ordered by the
    window bound, so the whole step hash-aggregates in a single pass over the windows.
    """
    picked = ("last_price", "return_5m", "quote_volume_5m", "trade_count_5m", "window_start")
    return windows.groupBy("symbol").agg(
        *history_columns(_RETURN_AND_VOLUME),
        *[F.max_by(name, "window_end").alias(name) for name in picked],
        F.max("window_end").alias("window_end"),
    )


def in_latest_window(per_symbol: DataFrame) -> DataFrame:
    """Symbols whose newest window is the newest of all; the aggregate below is exchanged once."""
    newest = per_symbol.agg(F.max("window_end")).scalar()
    return per_symbol.where(F.col("window_end") == newest)


def _return_z():
    return scoring.zscore_or_null(
        F.col("return_5m"), F.col("mean_return_5m"), F.col("std_return_5m")
    )


def _volume_z():
    return scoring.zscore_or_null(
        F.col("quote_volume_5m"), F.col("mean_quote_volume_5m"), F.col("std_quote_volume_5m")
    )


def _presented(rows: DataFrame, *scores: str) -> DataFrame:
    return rows.select(
        *[name for name in scores if name == "trend_rank"],
        "symbol",
        "last_price",
        F.col("return_5m").alias("return_5m_pct"),
        "quote_volume_5m",
        "trade_count_5m",
        *[name for name in scores if name != "trend_rank"],
        F.timestamp_millis("window_start").alias("window_start"),
        F.timestamp_millis("window_end").alias("window_end"),
    )


def trending_coins(windows: DataFrame) -> DataFrame:
    """Symbols of the newest window ranked by how far they are above their history."""
    scored = in_latest_window(history_and_latest(windows)).withColumn(
        "trend_score", scoring.signed_trend(_return_z(), _volume_z())
    )
    ranked = live_rank(scored, [F.desc("trend_score"), F.asc("symbol")], "trend_rank")
    return _presented(ranked, "trend_rank", "trend_score")


def _abnormal(rows: DataFrame, spike_z: float = ABNORMAL_ZSCORE) -> DataFrame:
    spikes = rows.withColumn("spike_zscore", _return_z()).where(
        F.abs("spike_zscore") >= spike_z
    )
    return _presented(
        spikes.orderBy(F.abs("spike_zscore").desc(), "symbol", "window_end"), "spike_zscore"
    )


def abnormal_price_spikes(windows: DataFrame, spike_z: float = ABNORMAL_ZSCORE) -> DataFrame:
    """Abnormal moves in the newest window, largest first."""
    return _abnormal(in_latest_window(history_and_latest(windows)), spike_z)


def abnormal_history(windows: DataFrame) -> DataFrame:
    """Abnormal moves in any window. Pass a written table, it is read twice."""
    stats = materialise(
        windows.groupBy("symbol").agg(*history_columns(("return_5m",))), "history"
    )
    return _abnormal(windows.join(stats, "symbol"))


def trend_history(windows: DataFrame) -> DataFrame:
    """Trend score of every window against the history of its symbol."""
    stats = materialise(
        windows.groupBy("symbol").agg(*history_columns(_RETURN_AND_VOLUME)), "history"
    )
    scored = windows.join(stats, "symbol").withColumn(
        "trend_score", scoring.signed_trend(_return_z(), _volume_z())
    )
    return _presented(scored, "trend_score")


def register_views(
    spark: SparkSession,
    events: str | DataFrame = "raw_market_events",
    windows: str | DataFrame = "batch_windows",
) -> None:
    """Make the four views available to SQL, over catalog tables or frames.

    Nothing runs here: a view is computed whenever it is read, from what its tables then hold.
    """
    event_rows = spark.table(events) if isinstance(events, str) else events
    window_rows = spark.table(windows) if isinstance(windows, str) else windows
    latest_market_prices(event_rows).createOrReplaceTempView("latest_market_prices")
    market_summary(event_rows).createOrReplaceTempView("market_summary")
    trending_coins(window_rows).createOrReplaceTempView("trending_coins")
    abnormal_price_spikes(window_rows).createOrReplaceTempView("abnormal_price_spikes")
