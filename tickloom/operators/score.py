"""Scoring of recent windows against baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import params, schemas
from tickloom.functions import events as fn
from tickloom.functions import scoring


def score_windows(
    recent: DataFrame,
    baseline_rows: DataFrame,
    observed_at: Column | int,
    min_liquidity: float = params.DEFAULT_MIN_LIQUIDITY,
    spike_zscore: float = params.DEFAULT_SPIKE_ZSCORE,
    spike_return_pct: float = params.DEFAULT_SPIKE_RETURN_PCT,
) -> DataFrame:
    """Join recent windows with the baseline of their symbol and score them.

    ``recent`` has symbol, start_price, end_price, quote_volume_5m, trade_count_5m, window_start
    and window_end. A symbol without baseline gives no row, nor does an illiquid one.
    ``observed_at`` is the clock that the serving latency is measured with.
    """
    observed = F.lit(observed_at).cast("long") if isinstance(observed_at, int) else observed_at
    liquid = baseline_rows.where(F.col("median_quote_volume_5m") >= min_liquidity)
    stats = liquid.select(
        "symbol",
        *[
            F.col(name).alias(f"_{name}")
            for name in liquid.columns
            if name in schemas.BASELINE.fieldNames() and name != "symbol"
        ],
    )
    joined = (
        recent.where(F.col("quote_volume_5m") >= min_liquidity)
        .withColumn("symbol", F.upper("symbol"))
        .join(stats, "symbol")
    )
    move = scoring.return_pct(F.col("start_price"), F.col("end_price"))

    def against(measure: str, value: Column) -> Column:
        return scoring.zscore_or_zero(value, F.col(f"_mean_{measure}"), F.col(f"_std_{measure}"))

    scored = joined.withColumn("return_5m_pct", move).withColumns(
        {
            "spike_zscore": against("return_5m", F.col("return_5m_pct")),
            "volume_zscore": against("quote_volume_5m", F.col("quote_volume_5m")),
            "trade_activity_zscore": against(
                "trade_count_5m", F.col("trade_count_5m").cast("double")
            ),
        }
    )
    flagged = scored.withColumns(
        {
            "trend_score": scoring.weighted_trend(
                F.col("volume_zscore"), F.col("spike_zscore"), F.col("trade_activity_zscore")
            ),
            "is_spike": scoring.spike_flag(
                F.col("spike_zscore"), F.col("return_5m_pct"), spike_zscore, spike_return_pct
            ),
        }
    )
    return flagged.withColumns(
        {
            "base_asset": fn.base_asset("symbol"),
            "price": F.col("end_price"),
            "latency_ms": scoring.delay_ms(observed, F.col("window_end")),
            "result_type": F.when(F.col("is_spike"), F.lit("spike")).otherwise(F.lit("trend")),
            "batch_mean_return_5m": F.col("_mean_return_5m"),
            "batch_mean_quote_volume_5m": F.col("_mean_quote_volume_5m"),
            "baseline_sample_count": F.col("_sample_count"),
            "baseline_updated_at": F.col("_updated_at"),
            "view_type": F.lit("hybrid"),
        }
    ).select(*schemas.SCORE_COLUMNS)


def aligned_as_recent(windows: DataFrame) -> DataFrame:
    """Aligned batch windows in the shape ``score_windows`` takes (end = last event time)."""
    return windows.select(
        "symbol",
        F.col("first_price").alias("start_price"),
        F.col("last_price").alias("end_price"),
        "quote_volume_5m",
        "trade_count_5m",
        F.col("first_event_time").alias("window_start"),
        F.col("last_event_time").alias("window_end"),
    )
