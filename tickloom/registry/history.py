"""Cleaning, windows, baselines and the four views."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import adapters
from tickloom.operators import baselines as base
from tickloom.operators.clean import clean_events
from tickloom.operators.latest import newest_overall
from tickloom.operators.metrics import event_counts
from tickloom.operators.windows import event_windows
from tickloom.plans import views
from tickloom.registry import Query
from tickloom.registry.shared import (
    SQL_BASELINE_COLUMNS,
    SQL_EVENTS,
    SQL_HISTORY,
    SQL_RAW_EVENTS,
    SQL_WINDOW_COLUMNS,
    SQL_WINDOWS,
    UPDATED_AT,
    events,
    hourly,
    hourly_baselines,
    hourly_table,
    rounded,
    sql_baselines,
    sql_windows,
    user_events,
)
from tickloom.session import materialise

# Unit prices are cents over a quantity up to 50, so at eight places none lies between two values.
PRICE = 8


def uneven_feed(spark: SparkSession, folder: str) -> DataFrame:
    """The trades as an untidy feed delivers them, by type.

    Clicks have microsecond clocks, views a lower-case symbol, sign-ups no volume, count or ingest
    time, and errors a price of zero when cheap.
    """
    trades = events(spark, folder)
    is_a = {name: F.col("symbol") == f"{name}USDT" for name in ("CLICK", "VIEW", "SIGNUP", "ERROR")}
    missing = F.lit(None)
    return trades.withColumns(
        {
            "event_time": F.when(is_a["CLICK"], F.col("event_time") * 1000 + 7).otherwise(
                F.col("event_time")
            ),
            "ingest_time": F.when(is_a["CLICK"], F.col("ingest_time") * 1000 + 9)
            .when(is_a["SIGNUP"], missing)
            .otherwise(F.col("ingest_time")),
            "quote_volume": F.when(is_a["SIGNUP"], missing).otherwise(F.col("quote_volume")),
            "trade_count": F.when(is_a["SIGNUP"], missing).otherwise(F.col("trade_count")),
            "last_price": F.when(is_a["ERROR"] & (F.col("last_price") < 20), 0.0).otherwise(
                F.col("last_price")
            ),
            "symbol": F.when(is_a["VIEW"], F.lower("symbol")).otherwise(F.col("symbol")),
        }
    )


def _clean(lenient: bool) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        cleaned = clean_events(uneven_feed(spark, folder), lenient)
        return rounded(cleaned.drop("schema_version", "event_type"))

    return query


_CLEAN_SQL = f"""WITH {SQL_EVENTS}
SELECT symbol, base_asset, event_time, round(last_price, 6) AS last_price,
  {{volume}}, trade_count, {{ingest}} AS ingest_time, trade_id,
  make_timestamp(event_time * 1000) AS event_timestamp
FROM m WHERE NOT (symbol = 'ERRORUSDT' AND last_price < 20) {{extra}}"""


def event_windows_5m(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(event_windows(events(spark, folder)))


def event_windows_closed(spark: SparkSession, folder: str) -> DataFrame:
    """Six-hour windows with an unbounded id key, only those that ended before 2024-01-21."""
    closed = int(datetime(2024, 1, 21, tzinfo=timezone.utc).timestamp() * 1000)
    return rounded(
        event_windows(events(spark, folder), "6 hours", min_records=1, closed_before=closed)
    )


def user_windows(spark: SparkSession, folder: str) -> DataFrame:
    trades = user_events(spark, folder)
    return rounded(event_windows(trades, "1 day"))


def _brand_windows(spark: SparkSession, folder: str) -> DataFrame:
    return event_windows(adapters.brand_events(spark, folder), "30 days")


def brand_windows(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        _brand_windows(spark, folder), quote_volume_5m=2, first_price=PRICE, last_price=PRICE
    )


def brand_baselines(spark: SparkSession, folder: str) -> DataFrame:
    rows = base.baselines(materialise(_brand_windows(spark, folder), "windows"), UPDATED_AT)
    return rounded(
        rows, mean_quote_volume_5m=4, std_quote_volume_5m=4, median_quote_volume_5m=4
    )


def brand_trend(spark: SparkSession, folder: str) -> DataFrame:
    ranked = views.trending_coins(_brand_windows(spark, folder))
    return rounded(ranked, quote_volume_5m=2, last_price=PRICE)


def event_windows_1h(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(hourly(spark, folder))


def baselines_1h(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(base.tagged(hourly_baselines(spark, folder)))


def baselines_approx(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(base.baselines(hourly(spark, folder), UPDATED_AT, median="approx"))


def user_baselines(spark: SparkSession, folder: str) -> DataFrame:
    trades = user_events(spark, folder)
    daily = materialise(event_windows(trades, "1 day"), "windows")
    return rounded(base.baselines(daily, UPDATED_AT))


def history_statistics(spark: SparkSession, folder: str) -> DataFrame:
    stats = base.history_columns(("return_5m", "quote_volume_5m"))
    return rounded(hourly(spark, folder).groupBy("symbol").agg(*stats))


def latest_window(spark: SparkSession, folder: str) -> DataFrame:
    return newest_overall(hourly(spark, folder)).withColumnRenamed("newest", "window_end")


def trending_latest(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(views.trending_coins(hourly(spark, folder)))


def trend_history(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(views.trend_history(hourly_table(spark, folder)))


def spikes_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Brands' moves in their newest window, from a threshold low enough that there are some."""
    spikes = views.abnormal_price_spikes(_brand_windows(spark, folder), spike_z=0.25)
    return rounded(spikes, quote_volume_5m=2, last_price=PRICE)


def spikes_history(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(views.abnormal_history(hourly_table(spark, folder)))


def latest_prices(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(views.latest_market_prices(adapters.market_events(spark, folder)))


def user_latest_prices(spark: SparkSession, folder: str) -> DataFrame:
    """The same view through the struct key, for ids without a known bound."""
    return rounded(views.latest_market_prices(adapters.user_events(spark, folder)))


def market_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(views.market_summary(adapters.market_events(spark, folder)))


def event_symbol_count(spark: SparkSession, folder: str) -> DataFrame:
    return event_counts(adapters.market_events(spark, folder))


QUERIES: dict[str, Query] = {
    "clean_events": _clean(False),
    "clean_events_lenient": _clean(True),
    "event_windows": event_windows_1h,
    "event_windows_5m": event_windows_5m,
    "event_windows_closed": event_windows_closed,
    "user_windows": user_windows,
    "brand_windows": brand_windows,
    "baselines": baselines_1h,
    "baselines_approx": baselines_approx,
    "user_baselines": user_baselines,
    "brand_baselines": brand_baselines,
    "history_statistics": history_statistics,
    "latest_window": latest_window,
    "trending_latest": trending_latest,
    "brand_trend": brand_trend,
    "trend_history": trend_history,
    "spikes_latest": spikes_latest,
    "spikes_history": spikes_history,
    "latest_prices": latest_prices,
    "user_latest_prices": user_latest_prices,
    "market_summary": market_summary,
    "event_symbol_count": event_symbol_count,
}

_USERS = f"{SQL_EVENTS}, u AS (SELECT * REPLACE ('U' || user_id || 'USDT' AS symbol, 'U' || user_id AS base_asset) FROM m)"
_BRANDS = """m AS (
  SELECT upper(replace(p_brand, '#', '')) || 'USDT' AS symbol, epoch_ms(l_shipdate) AS event_time,
         l_extendedprice / l_quantity AS last_price, l_extendedprice AS quote_volume,
         CAST(l_quantity AS BIGINT) AS trade_count,
         epoch_ms(l_shipdate) + l_linenumber * 1000 AS ingest_time,
         l_orderkey * 8 + l_linenumber AS trade_id
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_BRAND_WINDOWS = f"WITH {_BRANDS}, {sql_windows(length_ms=2_592_000_000)}"
_LATEST = "l AS (SELECT max(window_end) AS window_end FROM w)"
_ZSCORES = """h AS (
  SELECT symbol, avg(return_5m) AS mr, stddev_samp(return_5m) AS sr,
         avg(quote_volume_5m) AS mv, stddev_samp(quote_volume_5m) AS sv
  FROM w GROUP BY symbol),
sc AS (
  SELECT w.*, (return_5m - mr) / nullif(sr, 0) AS rz,
         (quote_volume_5m - mv) / nullif(sv, 0) AS vz
  FROM w JOIN h ON h.symbol = w.symbol)"""
_SHOWN = """symbol, round(last_price, {price}) AS last_price, round(return_5m, 6) AS return_5m_pct,
  round(quote_volume_5m, {places}) AS quote_volume_5m, trade_count_5m,
  make_timestamp(window_start * 1000) AS window_start,
  make_timestamp(window_end * 1000) AS window_end"""
_SHOWN_6 = _SHOWN.format(places=6, price=6)
_TREND = "round(coalesce(rz, 0) + coalesce(vz, 0), 6) AS trend_score"
_RANK = "row_number() OVER (ORDER BY coalesce(rz, 0) + coalesce(vz, 0) DESC, symbol) AS trend_rank"
_IS_LATEST = "window_end = (SELECT window_end FROM l)"


def _prices_sql(source: str) -> str:
    return f"""
SELECT symbol, base_asset, round(last_price, 6) AS last_price,
  round(quote_volume, 6) AS quote_volume, make_timestamp(event_time * 1000) AS event_timestamp,
  greatest(0, ingest_time - event_time) AS ingestion_latency_ms
FROM {source} WHERE last_price > 0
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC, trade_id DESC) = 1"""


ORACLES: dict[str, str] = {
    "clean_events": _CLEAN_SQL.format(
        volume="round(quote_volume, 6) AS quote_volume",
        ingest="ingest_time",
        extra="AND symbol <> 'SIGNUPUSDT'",
    ),
    "clean_events_lenient": _CLEAN_SQL.format(
        volume="CASE WHEN symbol = 'SIGNUPUSDT' THEN 0 ELSE round(quote_volume, 6) END AS quote_volume",
        ingest="CASE WHEN symbol = 'SIGNUPUSDT' THEN event_time ELSE ingest_time END",
        extra="",
    ),
    "event_windows": f"{SQL_WINDOWS} SELECT {SQL_WINDOW_COLUMNS} FROM w",
    "event_windows_5m": f"""WITH {SQL_EVENTS}, {sql_windows(length_ms=300_000)}
SELECT {SQL_WINDOW_COLUMNS} FROM w""",
    "event_windows_closed": f"""WITH {SQL_EVENTS}, {sql_windows(length_ms=21_600_000, least=1)}
SELECT {SQL_WINDOW_COLUMNS} FROM w WHERE window_end <= epoch_ms(TIMESTAMP '2024-01-21')""",
    "user_windows": f"""WITH {_USERS}, {sql_windows("u", length_ms=86_400_000)}
SELECT {SQL_WINDOW_COLUMNS} FROM w""",
    "brand_windows": f"""{_BRAND_WINDOWS}
SELECT {SQL_WINDOW_COLUMNS.replace("quote_volume_5m, 6)", "quote_volume_5m, 2)").replace("price, 6)", f"price, {PRICE})")}
FROM w""",
    "baselines": f"""{SQL_HISTORY}
SELECT {SQL_BASELINE_COLUMNS}, 'batch_baseline' AS view_type,
  CAST(2 AS BIGINT) AS schema_version FROM b""",
    "baselines_approx": f"""{SQL_WINDOWS},
{sql_baselines().replace("median(quote_volume_5m)", "quantile_disc(quote_volume_5m, 0.5)")}
SELECT {SQL_BASELINE_COLUMNS} FROM b""",
    "user_baselines": f"""WITH {_USERS}, {sql_windows("u", length_ms=86_400_000)}, {sql_baselines()}
SELECT {SQL_BASELINE_COLUMNS} FROM b""",
    "brand_baselines": f"""{_BRAND_WINDOWS}, {sql_baselines()}
SELECT {SQL_BASELINE_COLUMNS.replace("quote_volume_5m, 6)", "quote_volume_5m, 4)")} FROM b""",
    "history_statistics": f"""{SQL_WINDOWS}
SELECT symbol, round(avg(return_5m), 6) AS mean_return_5m,
  round(stddev_samp(return_5m), 6) AS std_return_5m,
  round(avg(quote_volume_5m), 6) AS mean_quote_volume_5m,
  round(stddev_samp(quote_volume_5m), 6) AS std_quote_volume_5m
FROM w GROUP BY symbol""",
    "latest_window": f"{SQL_WINDOWS} SELECT max(window_end) AS window_end FROM w",
    "trending_latest": f"""{SQL_WINDOWS}, {_LATEST}, {_ZSCORES}
SELECT {_RANK}, {_SHOWN_6}, {_TREND} FROM sc WHERE {_IS_LATEST}""",
    "brand_trend": f"""{_BRAND_WINDOWS}, {_LATEST}, {_ZSCORES}
SELECT {_RANK}, {_SHOWN.format(places=2, price=PRICE)}, {_TREND} FROM sc WHERE {_IS_LATEST}""",
    "trend_history": f"""{SQL_WINDOWS}, {_ZSCORES} SELECT {_SHOWN_6}, {_TREND} FROM sc""",
    "spikes_latest": f"""{_BRAND_WINDOWS}, {_LATEST}, {_ZSCORES}
SELECT {_SHOWN.format(places=2, price=PRICE)}, round(rz, 6) AS spike_zscore FROM sc WHERE {_IS_LATEST} AND abs(rz) >= 0.25""",
    "spikes_history": f"""{SQL_WINDOWS}, {_ZSCORES}
SELECT {_SHOWN_6}, round(rz, 6) AS spike_zscore FROM sc WHERE abs(rz) >= 3""",
    "latest_prices": f"WITH {SQL_RAW_EVENTS} {_prices_sql('m')}",
    "user_latest_prices": f"WITH {_USERS} {_prices_sql('u')}",
    "market_summary": f"""WITH {SQL_RAW_EVENTS}
SELECT symbol, count(*) AS event_count,
  make_timestamp(min(event_time) * 1000) AS first_event_timestamp,
  make_timestamp(max(event_time) * 1000) AS latest_event_timestamp,
  round(sum(quote_volume), 6) AS total_quote_volume,
  round(avg(last_price), 6) AS average_trade_price,
  max(ingest_time - event_time) AS maximum_ingestion_latency_ms
FROM m GROUP BY symbol""",
    "event_symbol_count": f"""WITH {SQL_RAW_EVENTS}
SELECT count(*) AS event_count, count(DISTINCT symbol) AS symbol_count FROM m""",
}
