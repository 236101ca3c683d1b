"""Hybrid views: the recent window of each symbol scored against its history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import params
from tickloom.operators.buckets import latest_bucket_window
from tickloom.operators.ranking import top_spikes, top_trending
from tickloom.operators.score import score_windows
from tickloom.operators.sliding import latest_sliding
from tickloom.session import materialise


def hybrid_from_events(
    events: DataFrame,
    baseline_rows: DataFrame,
    observed_at: Column | int,
    settings: params.Params = params.Params(),
    dedupe: bool = False,
) -> DataFrame:
    """Score the sliding window that ends at the newest event of each symbol."""
    recent = latest_sliding(events, settings.window, settings.min_records, dedupe)
    return _scored(recent, baseline_rows, observed_at, settings)


def hybrid_from_buckets(
    events: DataFrame,
    baseline_rows: DataFrame,
    observed_at: Column | int,
    settings: params.Params = params.Params(),
) -> DataFrame:
    """Score the recent window kept as time buckets; at least two buckets are needed."""
    recent = latest_bucket_window(
        events, settings.window, settings.bucket_ms, settings.min_records
    )
    return _scored(recent, baseline_rows, observed_at, settings)


def _scored(
    recent: DataFrame,
    baseline_rows: DataFrame,
    observed_at: Column | int,
    settings: params.Params,
) -> DataFrame:
    return score_windows(
        recent,
        baseline_rows,
        observed_at,
        settings.min_liquidity,
        settings.spike_zscore,
        settings.spike_return_pct,
    )


def serving_views(scores: DataFrame, n: int = params.DEFAULT_TOP_N) -> tuple[DataFrame, DataFrame]:
    """Top trends and top spikes out of one scoring pass."""
    written = materialise(scores, "scores")
    return top_trending(written, n, "rank"), top_spikes(written, n, "spike_rank")


def both_lists(trending: DataFrame, spikes: DataFrame) -> DataFrame:
    """The two lists under each other, marked by ``list``."""
    first = trending.withColumnRenamed("rank", "place").withColumn("list", F.lit("trend"))
    second = spikes.withColumnRenamed("spike_rank", "place").withColumn("list", F.lit("spike"))
    return first.unionByName(second)
