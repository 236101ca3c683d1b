"""Inputs and SQL fragments that several queries use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tickloom import adapters, params
from tickloom.operators.baselines import baselines
from tickloom.operators.windows import event_windows
from tickloom.session import materialise

HOUR = "1 hour"
UPDATED_AT = "2024-02-01T00:00:00+00:00"
MIN_LIQUIDITY = 1_000.0
SETTINGS = params.Params(window=HOUR, min_liquidity=MIN_LIQUIDITY, bucket_ms=60_000)
# Observation clock of the serving latency: the newest window end plus this.
OBSERVED_DELAY_MS = 1_500


def rounded(df: DataFrame, **places: int) -> DataFrame:
    """All double columns rounded, to six places unless given otherwise."""
    return df.selectExpr(
        *[
            f"round({field.name}, {places.get(field.name, 6)}) AS {field.name}"
            if isinstance(field.dataType, T.DoubleType)
            else field.name
            for field in df.schema.fields
        ]
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Trades with a price, as cleaning leaves them."""
    return adapters.market_events(spark, folder).where("last_price > 0")


def user_events(spark: SparkSession, folder: str) -> DataFrame:
    """The same trades keyed by user."""
    return adapters.user_events(spark, folder).where("last_price > 0")


def hourly(spark: SparkSession, folder: str) -> DataFrame:
    return event_windows(events(spark, folder), HOUR)


def hourly_table(spark: SparkSession, folder: str) -> DataFrame:
    return materialise(hourly(spark, folder), "windows")


def hourly_baselines(spark: SparkSession, folder: str) -> DataFrame:
    return baselines(hourly_table(spark, folder), UPDATED_AT)


# Trades of the events table: all of them, and those with a price.
SQL_RAW_EVENTS = """m AS (
  SELECT upper(event_type) || 'USDT' AS symbol, upper(event_type) AS base_asset,
         epoch_us(ts) // 1000 AS event_time, value AS last_price,
         value * (1 + CAST(regexp_extract(props, '[0-9]+') AS BIGINT)) AS quote_volume,
         CAST(1 AS BIGINT) AS trade_count, epoch_us(ts) // 1000 + event_id % 500 AS ingest_time,
         event_id AS trade_id, user_id
  FROM events)"""
SQL_EVENTS = SQL_RAW_EVENTS.replace("FROM events)", "FROM events WHERE value > 0)")


def sql_windows(source: str = "m", name: str = "w", length_ms: int = 3_600_000, least: int = 2) -> str:
    """Aligned windows of ``source`` as a common table expression."""
    start = f"event_time - event_time % {length_ms}"
    return f"""{name} AS (
  SELECT *, (last_price / first_price - 1) * 100 AS return_5m,
         greatest(0, last_ingest_time - last_event_time) AS latency_ms
  FROM (
    SELECT symbol, {start} AS window_start, {start} + {length_ms} AS window_end,
           first(last_price ORDER BY event_time, trade_id, last_price) AS first_price,
           last(last_price ORDER BY event_time, trade_id, last_price) AS last_price,
           sum(quote_volume) AS quote_volume_5m,
           CAST(sum(trade_count) AS BIGINT) AS trade_count_5m, count(*) AS record_count,
           min(event_time) AS first_event_time, max(event_time) AS last_event_time,
           max(ingest_time) AS last_ingest_time
    FROM {source} GROUP BY symbol, {start} HAVING count(*) >= {least}))"""


def sql_baselines(windows: str = "w", name: str = "b") -> str:
    """Baselines of a windows expression as a common table expression."""
    return f"""{name} AS (
  SELECT symbol, avg(return_5m) AS mean_return_5m,
         coalesce(stddev_samp(return_5m), 0) AS std_return_5m,
         avg(quote_volume_5m) AS mean_quote_volume_5m,
         coalesce(stddev_samp(quote_volume_5m), 0) AS std_quote_volume_5m,
         median(quote_volume_5m) AS median_quote_volume_5m, count(*) AS sample_count,
         '{UPDATED_AT}' AS updated_at, avg(trade_count_5m) AS mean_trade_count_5m,
         coalesce(stddev_samp(trade_count_5m), 0) AS std_trade_count_5m
  FROM {windows} GROUP BY symbol)"""


# The frames below name the columns of two tables with doubles rounded to six places.
SQL_WINDOW_COLUMNS = """symbol, window_start, window_end, round(first_price, 6) AS first_price,
  round(last_price, 6) AS last_price, round(quote_volume_5m, 6) AS quote_volume_5m,
  trade_count_5m, record_count, first_event_time, last_event_time, last_ingest_time,
  round(return_5m, 6) AS return_5m, latency_ms"""
SQL_BASELINE_COLUMNS = """symbol, round(mean_return_5m, 6) AS mean_return_5m,
  round(std_return_5m, 6) AS std_return_5m,
  round(mean_quote_volume_5m, 6) AS mean_quote_volume_5m,
  round(std_quote_volume_5m, 6) AS std_quote_volume_5m,
  round(median_quote_volume_5m, 6) AS median_quote_volume_5m, sample_count, updated_at,
  round(mean_trade_count_5m, 6) AS mean_trade_count_5m,
  round(std_trade_count_5m, 6) AS std_trade_count_5m"""
SQL_WINDOWS = f"WITH {SQL_EVENTS}, {sql_windows()}"
SQL_HISTORY = f"{SQL_WINDOWS}, {sql_baselines()}"


def sql_scores(
    recent: str,
    observed: str,
    name: str = "s",
    min_liquidity: float = MIN_LIQUIDITY,
) -> str:
    """Scores of a recent-window expression against ``b``, as a common table expression.

    ``recent`` has symbol, start_price, end_price, quote_volume_5m, trade_count_5m, window_start
    and window_end; ``observed`` is a scalar expression.
    """
    return f"""z AS (
  SELECT r.*, b.mean_return_5m, b.mean_quote_volume_5m, b.sample_count, b.updated_at,
         CASE WHEN start_price > 0 THEN (end_price / start_price - 1) * 100 ELSE 0 END AS move,
         b.std_return_5m,
         CASE WHEN b.std_quote_volume_5m > 1e-12
              THEN (r.quote_volume_5m - b.mean_quote_volume_5m) / b.std_quote_volume_5m
              ELSE 0 END AS volume_zscore,
         CASE WHEN b.std_trade_count_5m > 1e-12
              THEN (r.trade_count_5m - b.mean_trade_count_5m) / b.std_trade_count_5m
              ELSE 0 END AS trade_activity_zscore
  FROM {recent} r JOIN b ON b.symbol = r.symbol
  WHERE b.median_quote_volume_5m >= {min_liquidity} AND r.quote_volume_5m >= {min_liquidity}),
z2 AS (
  SELECT *, CASE WHEN std_return_5m > 1e-12 THEN (move - mean_return_5m) / std_return_5m
                 ELSE 0 END AS spike_zscore
  FROM z),
{name} AS (
  SELECT symbol, replace(symbol, 'USDT', '') AS base_asset, end_price AS price,
         move AS return_5m_pct, quote_volume_5m, trade_count_5m,
         0.45 * volume_zscore + 0.35 * abs(spike_zscore) + 0.20 * trade_activity_zscore
           AS trend_score,
         spike_zscore, abs(spike_zscore) >= 3 AND abs(move) >= 1.5 AS is_spike,
         window_start, window_end, greatest(0, {observed} - window_end) AS latency_ms,
         CASE WHEN abs(spike_zscore) >= 3 AND abs(move) >= 1.5 THEN 'spike' ELSE 'trend' END
           AS result_type,
         volume_zscore, trade_activity_zscore, mean_return_5m AS batch_mean_return_5m,
         mean_quote_volume_5m AS batch_mean_quote_volume_5m,
         sample_count AS baseline_sample_count, updated_at AS baseline_updated_at,
         'hybrid' AS view_type
  FROM z2)"""


SQL_SCORE_COLUMNS = """symbol, base_asset, round(price, 6) AS price,
  round(return_5m_pct, 6) AS return_5m_pct, round(quote_volume_5m, 6) AS quote_volume_5m,
  trade_count_5m, round(trend_score, 6) AS trend_score, round(spike_zscore, 6) AS spike_zscore,
  is_spike, window_start, window_end, latency_ms, result_type,
  round(volume_zscore, 6) AS volume_zscore,
  round(trade_activity_zscore, 6) AS trade_activity_zscore,
  round(batch_mean_return_5m, 6) AS batch_mean_return_5m,
  round(batch_mean_quote_volume_5m, 6) AS batch_mean_quote_volume_5m,
  baseline_sample_count, baseline_updated_at, view_type"""
