"""Sliding windows, buckets, hybrid scores and the serving lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom import adapters, params
from tickloom.operators import buckets as bk
from tickloom.operators import replay, serving
from tickloom.operators.dedupe import dedupe_trades, distinct_symbols
from tickloom.operators.latest import newest_times
from tickloom.operators.ranking import top_spikes, top_trending
from tickloom.operators.score import aligned_as_recent, score_windows
from tickloom.operators.sliding import latest_sliding, sliding_windows
from tickloom.operators.windows import event_windows
from tickloom.operators.baselines import baselines
from tickloom.plans import hybrid
from tickloom.registry import Query
from tickloom.registry.history import PRICE
from tickloom.registry.shared import (
    HOUR,
    MIN_LIQUIDITY,
    OBSERVED_DELAY_MS,
    SETTINGS,
    SQL_EVENTS,
    SQL_HISTORY,
    SQL_SCORE_COLUMNS,
    UPDATED_AT,
    events,
    hourly_table,
    rounded,
    sql_baselines,
    sql_scores,
    sql_windows,
    user_events,
)
from tickloom.session import materialise

BUCKET_MS = SETTINGS.bucket_ms
FRESHNESS_MS = 1_800_000
EXPIRES_AT = 1_800_000_000
USER_SETTINGS = params.Params(window="1 day", min_liquidity=100.0, bucket_ms=60_000)


def observed(windows: DataFrame, column: str):
    """Observation clock: the largest ``column`` plus a fixed delay."""
    return windows.agg(F.max(column)).scalar() + OBSERVED_DELAY_MS


def _history_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every hourly window scored as if it were the recent one."""
    windows = hourly_table(spark, folder)
    recent = aligned_as_recent(windows)
    return score_windows(
        recent,
        materialise(baselines(windows, UPDATED_AT), "baselines"),
        observed(recent, "window_end"),
        MIN_LIQUIDITY,
    )


def hybrid_scores(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_history_scores(spark, folder))


def _user_baselines(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    trades = user_events(spark, folder)
    windows = materialise(event_windows(trades, "1 day"), "windows")
    return trades, baselines(windows, UPDATED_AT)


def user_hybrid(spark: SparkSession, folder: str) -> DataFrame:
    """Recent day of each user against the user's own daily history."""
    trades, stats = _user_baselines(spark, folder)
    return hybrid.hybrid_from_events(
        trades, stats, observed(trades, "event_time"), USER_SETTINGS, dedupe=True
    )


def hybrid_latest(spark: SparkSession, folder: str) -> DataFrame:
    trades = events(spark, folder)
    stats = baselines(hourly_table(spark, folder), UPDATED_AT)
    clock = observed(trades, "event_time")
    return rounded(hybrid.hybrid_from_events(trades, stats, clock, SETTINGS))


def hybrid_buckets(spark: SparkSession, folder: str) -> DataFrame:
    trades, stats = _user_baselines(spark, folder)
    clock = observed(trades, "event_time")
    return rounded(
        hybrid.hybrid_from_buckets(trades, stats, clock, USER_SETTINGS)
    )


def user_hybrid_scores(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(user_hybrid(spark, folder))


def top_trending_users(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(top_trending(user_hybrid(spark, folder), params.DEFAULT_TOP_N, "rank"))


def top_spike_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Largest abnormal moves of the whole history."""
    spikes = _history_scores(spark, folder).withColumn(
        "symbol", F.concat_ws("@", "symbol", F.col("window_end").cast("string"))
    )
    return rounded(top_spikes(spikes, params.DEFAULT_TOP_N, "spike_rank"))


def _spike_settings() -> params.Params:
    return params.Params(
        window="1 day", min_liquidity=100.0, spike_zscore=0.5, spike_return_pct=10.0
    )


def _sensitive_users(spark: SparkSession, folder: str) -> DataFrame:
    """User scores with thresholds low enough that several users spike."""
    trades, stats = _user_baselines(spark, folder)
    return hybrid.hybrid_from_events(
        trades, stats, observed(trades, "event_time"), _spike_settings(), dedupe=True
    )


def serving_top_lists(spark: SparkSession, folder: str) -> DataFrame:
    trending, spikes = hybrid.serving_views(_sensitive_users(spark, folder))
    return rounded(hybrid.both_lists(trending, spikes))


def sliding_window(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(sliding_windows(events(spark, folder), HOUR))


def brand_sliding_window(spark: SparkSession, folder: str) -> DataFrame:
    """Thirty sliding days per brand; many sales share a day and ids repeat."""
    daily = sliding_windows(adapters.brand_events(spark, folder), "30 days")
    # Rows of one day differ in their id only and ids repeat, so compare the distinct windows.
    return rounded(
        daily.drop("trade_id").distinct(), quote_volume_5m=2, start_price=PRICE, end_price=PRICE
    )


def sliding_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Sliding hours whose volumes span twelve orders of magnitude, to nine significant digits."""
    wide = events(spark, folder).withColumn(
        "quote_volume",
        F.col("last_price") * 0.7310585786 * F.pow(F.lit(10.0), F.pmod("trade_id", F.lit(13)) - 4),
    )
    volume = F.col("quote_volume_5m")
    power = F.floor(F.log10(volume))
    return sliding_windows(wide, HOUR).select(
        "symbol",
        "event_time",
        "trade_id",
        power.cast("long").alias("power"),
        F.round(volume / F.pow(F.lit(10.0), power), 8).alias("digits"),
    )


def sliding_latest(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(latest_sliding(user_events(spark, folder), "1 day", min_records=1))


def time_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(bk.time_buckets(events(spark, folder), BUCKET_MS))


def second_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(bk.time_buckets(events(spark, folder)))


def bucket_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Buckets of two interleaved halves of the trades, merged."""
    trades = events(spark, folder)
    dear = bk.time_buckets(trades.where(F.col("last_price") >= 50), 3_600_000)
    cheap = bk.time_buckets(trades.where(F.col("last_price") < 50), 3_600_000)
    return rounded(bk.merge_buckets(dear, cheap))


def bucket_rollup(spark: SparkSession, folder: str) -> DataFrame:
    trades = user_events(spark, folder)
    return rounded(bk.latest_bucket_window(trades, "1 day", BUCKET_MS))


def bucket_state(spark: SparkSession, folder: str) -> DataFrame:
    """State rows per user, taken apart again: every bucket, with the checkpoints of its shards."""
    shard = F.format_string("shard-%d", F.pmod(F.expr("event_time div 60000"), F.lit(4)))
    trades = user_events(spark, folder).withColumns(
        {"_shard_id": shard, "_sequence": (F.col("trade_id") + 1).cast("string")}
    )
    buckets = materialise(bk.time_buckets(trades, BUCKET_MS), "buckets")
    state = bk.bucket_state(
        bk.retain_recent(buckets, 86_400_000), replay.advance_checkpoints(trades)
    )
    entries = F.array_sort(
        F.transform(F.map_entries("checkpoints"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    )
    return rounded(
        state.select(
            "symbol",
            F.array_join(entries, ",").alias("checkpoints"),
            "newest_event_time",
            F.inline("buckets"),
        )
    )


def newest_event_times(spark: SparkSession, folder: str) -> DataFrame:
    return newest_times(user_events(spark, folder))


def dedup_trades(spark: SparkSession, folder: str) -> DataFrame:
    """Sales with one row per (brand, id); single items count as without id."""
    sales = adapters.brand_events(spark, folder).withColumn(
        "trade_id", F.when(F.col("trade_count") > 1, F.col("trade_id"))
    )
    return rounded(dedupe_trades(sales), last_price=PRICE)


def symbols(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_symbols(adapters.brand_events(spark, folder))


def _stored_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Score rows of every user window, as a store holds them over time."""
    return materialise(_sensitive_users(spark, folder), "stored")


def serving_hybrid(spark: SparkSession, folder: str) -> DataFrame:
    trending, _ = serving.serving_lists(_stored_scores(spark, folder), FRESHNESS_MS * 4)
    return rounded(trending)


def serving_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Both served lists next to the newest window of the store."""
    return rounded(serving.snapshot(_stored_scores(spark, folder), FRESHNESS_MS * 4))


def serving_hybrid_spikes(spark: SparkSession, folder: str) -> DataFrame:
    _, spikes = serving.serving_lists(_stored_scores(spark, folder), FRESHNESS_MS * 4)
    return rounded(spikes)


def _ranked_store(spark: SparkSession, folder: str) -> DataFrame:
    """Stored trend and spike rows of every hour: ranked per window, one key per list and symbol."""
    scores = _history_scores(spark, folder).withColumn(
        "window_end", F.col("window_end") - F.pmod("window_end", F.lit(3_600_000))
    )
    place = Window.partitionBy("window_end").orderBy(F.desc("trend_score"), "symbol")
    trends = scores.withColumn("rank", F.row_number().over(place).cast("long"))
    volume = Window.partitionBy("window_end").orderBy(F.desc("volume_zscore"), "symbol")
    busy = scores.where(F.col("volume_zscore") > 0).withColumn(
        "spike_rank", F.row_number().over(volume).cast("long")
    )
    return materialise(serving.serving_rows(trends, busy, EXPIRES_AT), "stored")


def serving_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_ranked_store(spark, folder))


def serving_legacy(spark: SparkSession, folder: str) -> DataFrame:
    stored = _ranked_store(spark, folder).drop("view_type")
    trending, spikes = serving.serving_lists(stored)
    return rounded(trending.unionByName(spikes))


def serving_two_step(spark: SparkSession, folder: str) -> DataFrame:
    stored = serving.unexpired(_ranked_store(spark, folder), EXPIRES_AT - 1)
    return rounded(serving.latest_stored(stored))


QUERIES: dict[str, Query] = {
    "hybrid_scores": hybrid_scores,
    "hybrid_latest": hybrid_latest,
    "user_hybrid_scores": user_hybrid_scores,
    "hybrid_buckets": hybrid_buckets,
    "top_trending": top_trending_users,
    "top_spikes": top_spike_windows,
    "serving_top_lists": serving_top_lists,
    "sliding_window": sliding_window,
    "brand_sliding_window": brand_sliding_window,
    "sliding_wide": sliding_wide,
    "sliding_latest": sliding_latest,
    "time_buckets": time_buckets,
    "second_buckets": second_buckets,
    "bucket_merge": bucket_merge,
    "bucket_rollup": bucket_rollup,
    "bucket_state": bucket_state,
    "newest_event_times": newest_event_times,
    "dedup_trades": dedup_trades,
    "distinct_symbols": symbols,
    "serving_hybrid": serving_hybrid,
    "serving_snapshot": serving_snapshot,
    "serving_hybrid_spikes": serving_hybrid_spikes,
    "serving_rows": serving_rows,
    "serving_legacy": serving_legacy,
    "serving_two_step": serving_two_step,
}

_USERS = f"""{SQL_EVENTS},
u AS (SELECT * REPLACE ('U' || user_id || 'USDT' AS symbol, 'U' || user_id AS base_asset) FROM m)"""
_USER_HISTORY = f"""WITH {_USERS}, {sql_windows("u", length_ms=86_400_000)}, {sql_baselines()}"""
_RECENT_HOURS = """r AS (
  SELECT symbol, first_price AS start_price, last_price AS end_price, quote_volume_5m,
         trade_count_5m, first_event_time AS window_start, last_event_time AS window_end FROM w)"""


def _sql_recent(source: str, length_ms: int, least: int = 2) -> str:
    return f"""n AS (SELECT symbol, max(event_time) AS newest FROM {source} GROUP BY symbol),
r AS (
  SELECT {source}.symbol, first(last_price ORDER BY event_time, trade_id) AS start_price,
         last(last_price ORDER BY event_time, trade_id) AS end_price,
         sum(quote_volume) AS quote_volume_5m,
         CAST(sum(trade_count) AS BIGINT) AS trade_count_5m, count(*) AS record_count,
         min(event_time) AS window_start, max(event_time) AS window_end
  FROM {source} JOIN n ON n.symbol = {source}.symbol AND event_time >= newest - {length_ms}
  GROUP BY {source}.symbol HAVING count(*) >= {least})"""


def _sql_buckets(source: str, length_ms: int, name: str = "k") -> str:
    start = f"event_time - event_time % {length_ms}"
    return f"""{name} AS (
  SELECT symbol, {start} AS bucket_start, min(event_time) AS first_event_time,
         max(event_time) AS last_event_time,
         first(trade_id ORDER BY event_time, trade_id) AS first_trade_id,
         last(trade_id ORDER BY event_time, trade_id) AS last_trade_id,
         first(last_price ORDER BY event_time, trade_id) AS first_price,
         last(last_price ORDER BY event_time, trade_id) AS last_price,
         sum(quote_volume) AS quote_volume, CAST(sum(trade_count) AS BIGINT) AS trade_count
  FROM {source} GROUP BY symbol, {start})"""


_BUCKET_COLUMNS = """symbol, bucket_start, first_event_time, last_event_time, first_trade_id,
  last_trade_id, round(first_price, 6) AS first_price, round(last_price, 6) AS last_price,
  round(quote_volume, 6) AS quote_volume, trade_count"""
_BUCKET_ROLLUP = f"""{_sql_buckets("u", BUCKET_MS)},
r AS (
  SELECT symbol, first(first_price ORDER BY bucket_start) AS start_price,
         last(last_price ORDER BY bucket_start) AS end_price,
         sum(quote_volume) AS quote_volume_5m,
         CAST(sum(trade_count) AS BIGINT) AS trade_count_5m, count(*) AS bucket_count,
         min(first_event_time) AS window_start, max(last_event_time) AS window_end
  FROM (SELECT k.*, max(last_event_time) OVER (PARTITION BY symbol) AS newest FROM k)
  WHERE last_event_time >= newest - 86400000
  GROUP BY symbol HAVING count(*) >= 2)"""
_OBSERVED_HOURS = f"((SELECT max(last_event_time) FROM w) + {OBSERVED_DELAY_MS})"
_OBSERVED_USERS = f"((SELECT max(event_time) FROM u) + {OBSERVED_DELAY_MS})"
_HOUR_SCORES = f"{SQL_HISTORY}, {_RECENT_HOURS}, {sql_scores('r', _OBSERVED_HOURS)}"
_USER_SCORES = (
    f"{_USER_HISTORY}, {_sql_recent('u', 86_400_000)}, "
    f"{sql_scores('r', _OBSERVED_USERS, min_liquidity=100.0)}"
)
_SENSITIVE = _USER_SCORES.replace(">= 3 AND", ">= 0.5 AND").replace(">= 1.5", ">= 10.0")
_SERVED = f"""{_SENSITIVE},
fresh AS (SELECT * REPLACE ('trend' AS result_type) FROM s
          WHERE window_end >= (SELECT max(window_end) FROM s) - {FRESHNESS_MS * 4}),
ranked AS (SELECT *, row_number() OVER (ORDER BY trend_score DESC, symbol) AS rank FROM fresh)"""
_STORED = f"""{_HOUR_SCORES},
h AS (SELECT * REPLACE (window_end - window_end % 3600000 AS window_end) FROM s),
t AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY trend_score DESC, symbol) AS rank
      FROM h),
v AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY volume_zscore DESC, symbol) AS rank
      FROM h WHERE volume_zscore > 0),
st AS (
  SELECT * REPLACE ('trend' AS result_type, CAST(window_end AS VARCHAR) AS window_end),
         'trend#' || symbol AS result_key, CAST({EXPIRES_AT} AS BIGINT) AS expires_at FROM t
  UNION ALL
  SELECT * REPLACE ('spike' AS result_type, CAST(window_end AS VARCHAR) AS window_end),
         'spike#' || symbol AS result_key, CAST({EXPIRES_AT} AS BIGINT) AS expires_at FROM v)"""
_NO_VIEW_TYPE = SQL_SCORE_COLUMNS.replace(", view_type", "")
_SLIDING = """SELECT symbol, event_time, trade_id, round(start_price, 6) AS start_price,
  round(end_price, 6) AS end_price, round(quote_volume_5m, 6) AS quote_volume_5m, trade_count_5m,
  record_count, window_start, event_time AS window_end
FROM (
  SELECT symbol, event_time, trade_id,
         first_value(last_price ORDER BY event_time, trade_id, last_price) OVER r AS start_price,
         last_value(last_price ORDER BY event_time, trade_id, last_price) OVER r AS end_price,
         sum(quote_volume) OVER r AS quote_volume_5m,
         CAST(sum(trade_count) OVER r AS BIGINT) AS trade_count_5m,
         count(*) OVER r AS record_count, min(event_time) OVER r AS window_start
  FROM m
  WINDOW r AS (PARTITION BY symbol ORDER BY event_time
               RANGE BETWEEN 3600000 PRECEDING AND CURRENT ROW))"""
_BRANDS = """m AS (
  SELECT upper(replace(p_brand, '#', '')) || 'USDT' AS symbol, epoch_us(l_shipdate) // 1000 AS event_time,
         l_extendedprice / l_quantity AS last_price, l_extendedprice AS quote_volume,
         CAST(l_quantity AS BIGINT) AS trade_count, l_orderkey * 8 + l_linenumber AS trade_id,
         epoch_us(l_shipdate) // 1000 + l_linenumber * 1000 AS ingest_time
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
# Per day first, since a window function with ordered aggregates over every row would be slow.
_BRAND_SLIDING = f"""WITH {_BRANDS},
d AS (
  SELECT symbol, event_time, first(last_price ORDER BY trade_id, last_price) AS opens,
         last(last_price ORDER BY trade_id, last_price) AS closes,
         sum(quote_volume) AS volume, sum(trade_count) AS trades, count(*) AS n
  FROM m GROUP BY symbol, event_time)
SELECT symbol, event_time, round(first_value(opens) OVER r, {PRICE}) AS start_price,
  round(closes, {PRICE}) AS end_price, round(sum(volume) OVER r, 2) AS quote_volume_5m,
  CAST(sum(trades) OVER r AS BIGINT) AS trade_count_5m, CAST(sum(n) OVER r AS BIGINT) AS record_count,
  min(event_time) OVER r AS window_start, event_time AS window_end
FROM d WINDOW r AS (PARTITION BY symbol ORDER BY event_time
                    RANGE BETWEEN 2592000000 PRECEDING AND CURRENT ROW)"""

ORACLES: dict[str, str] = {
    "hybrid_scores": f"{_HOUR_SCORES} SELECT {SQL_SCORE_COLUMNS} FROM s",
    "hybrid_latest": f"""{SQL_HISTORY}, {_sql_recent("m", 3_600_000)},
{sql_scores("r", f"((SELECT max(event_time) FROM m) + {OBSERVED_DELAY_MS})")}
SELECT {SQL_SCORE_COLUMNS} FROM s""",
    "user_hybrid_scores": f"{_USER_SCORES} SELECT {SQL_SCORE_COLUMNS} FROM s",
    "hybrid_buckets": f"""{_USER_HISTORY}, {_BUCKET_ROLLUP},
{sql_scores("r", _OBSERVED_USERS, min_liquidity=100.0)}
SELECT {SQL_SCORE_COLUMNS} FROM s""",
    "top_trending": f"""{_USER_SCORES}
SELECT {SQL_SCORE_COLUMNS}, row_number() OVER (ORDER BY s.trend_score DESC, symbol) AS rank FROM s
QUALIFY rank <= 10""",
    "top_spikes": f"""{_HOUR_SCORES},
p AS (SELECT * REPLACE (symbol || '@' || window_end AS symbol) FROM s WHERE is_spike)
SELECT {SQL_SCORE_COLUMNS},
  row_number() OVER (ORDER BY abs(p.spike_zscore) DESC, symbol) AS spike_rank
FROM p QUALIFY spike_rank <= 10""",
    "serving_top_lists": f"""{_SENSITIVE},
tt AS (SELECT *, 'trend' AS list, row_number() OVER (ORDER BY trend_score DESC, symbol) AS place FROM s),
ss AS (SELECT *, 'spike' AS list, row_number() OVER (ORDER BY abs(spike_zscore) DESC, symbol) AS place
       FROM s WHERE is_spike)
SELECT {SQL_SCORE_COLUMNS}, list, place
FROM (SELECT * FROM tt UNION ALL SELECT * FROM ss) WHERE place <= 10""",
    "sliding_window": f"WITH {SQL_EVENTS} {_SLIDING}",
    "brand_sliding_window": _BRAND_SLIDING,
    "sliding_wide": f"""WITH {SQL_EVENTS},
v AS (SELECT symbol, event_time, trade_id, sum(last_price * 0.7310585786::DOUBLE * pow(10.0::DOUBLE, trade_id % 13 - 4)) OVER (
        PARTITION BY symbol ORDER BY event_time RANGE BETWEEN 3600000 PRECEDING AND CURRENT ROW) AS volume
      FROM m)
SELECT symbol, event_time, trade_id, CAST(floor(log10(volume)) AS BIGINT) AS power,
  round(volume / pow(10.0::DOUBLE, floor(log10(volume))), 8) AS digits FROM v""",
    "sliding_latest": f"""WITH {_USERS}, {_sql_recent("u", 86_400_000, 1)}
SELECT symbol, round(start_price, 6) AS start_price, round(end_price, 6) AS end_price,
  round(quote_volume_5m, 6) AS quote_volume_5m, trade_count_5m, record_count, window_start,
  window_end FROM r""",
    "time_buckets": f"WITH {SQL_EVENTS}, {_sql_buckets('m', BUCKET_MS)} SELECT {_BUCKET_COLUMNS} FROM k",
    "second_buckets": f"WITH {SQL_EVENTS}, {_sql_buckets('m', 1_000)} SELECT {_BUCKET_COLUMNS} FROM k",
    "bucket_merge": f"""WITH {SQL_EVENTS}, {_sql_buckets('m', 3_600_000)}
SELECT {_BUCKET_COLUMNS} FROM k""",
    "bucket_rollup": f"""WITH {_USERS}, {_BUCKET_ROLLUP}
SELECT symbol, round(start_price, 6) AS start_price, round(end_price, 6) AS end_price,
  round(quote_volume_5m, 6) AS quote_volume_5m, trade_count_5m, bucket_count, window_start,
  window_end FROM r""",
    "bucket_state": f"""WITH {_USERS}, {_sql_buckets("u", BUCKET_MS)},
c AS (SELECT symbol, 'shard-' || (event_time // 60000) % 4 AS shard, max(trade_id + 1) AS reached
      FROM u GROUP BY ALL),
cs AS (SELECT symbol, string_agg(shard || '=' || reached, ',' ORDER BY shard) AS checkpoints
       FROM c GROUP BY symbol)
SELECT {_BUCKET_COLUMNS.replace("symbol,", "r.symbol,", 1)}, checkpoints, newest AS newest_event_time
FROM (SELECT k.*, max(last_event_time) OVER (PARTITION BY symbol) AS newest FROM k) r
JOIN cs ON cs.symbol = r.symbol
WHERE last_event_time >= newest - 86400000""",
    "newest_event_times": f"""WITH {_USERS}
SELECT symbol, max(event_time) AS newest FROM u GROUP BY symbol""",
    "dedup_trades": f"""WITH {_BRANDS},
i AS (SELECT * REPLACE (CASE WHEN trade_count > 1 THEN trade_id END AS trade_id) FROM m),
x AS (
  SELECT *, row_number() OVER (
      PARTITION BY symbol, trade_id
      ORDER BY event_time, last_price, quote_volume, trade_count, ingest_time) AS copy FROM i)
SELECT CAST(2 AS BIGINT) AS schema_version, 'sale' AS event_type, symbol,
  replace(symbol, 'USDT', '') AS base_asset, event_time, round(last_price, {PRICE}) AS last_price,
  round(quote_volume, 6) AS quote_volume, trade_count, ingest_time, trade_id
FROM x WHERE trade_id IS NULL OR copy = 1""",
    "distinct_symbols": f"WITH {_BRANDS} SELECT DISTINCT symbol FROM m",
    "serving_hybrid": f"{_SERVED} SELECT {SQL_SCORE_COLUMNS}, rank FROM ranked",
    "serving_snapshot": f"""{_SERVED},
both_lists AS (
  SELECT *, 'trend' AS list, rank AS place FROM ranked
  UNION ALL
  SELECT *, 'spike' AS list, row_number() OVER (ORDER BY abs(ranked.spike_zscore) DESC, symbol) AS place
  FROM ranked WHERE is_spike)
SELECT list, place, symbol, round(trend_score, 6) AS trend_score, window_end,
  (SELECT max(window_end) FROM s) AS latest_window
FROM both_lists""",
    "serving_hybrid_spikes": f"""{_SERVED}
SELECT {SQL_SCORE_COLUMNS}, rank,
  row_number() OVER (ORDER BY abs(ranked.spike_zscore) DESC, symbol) AS spike_rank
FROM ranked WHERE is_spike""",
    "serving_rows": f"{_STORED} SELECT {SQL_SCORE_COLUMNS}, rank, result_key, expires_at FROM st",
    "serving_legacy": f"""{_STORED}
SELECT {_NO_VIEW_TYPE}, rank, result_key, expires_at FROM st
WHERE CAST(window_end AS BIGINT) = (SELECT max(CAST(window_end AS BIGINT)) FROM st)""",
    "serving_two_step": f"""{_STORED}
SELECT {SQL_SCORE_COLUMNS}, rank, result_key, expires_at FROM st
WHERE window_end = (SELECT max(window_end) FROM st WHERE result_type = 'trend')""",
}
