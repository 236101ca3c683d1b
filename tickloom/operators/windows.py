"""Epoch-aligned event windows per symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import params, schemas
from tickloom.functions import events as fn
from tickloom.functions import scoring
from tickloom.functions.ordering import event_order


def measures(order: Column) -> list[Column]:
    """Aggregates of one window; none depends on the order in which rows arrive."""
    return [
        F.min_by("last_price", order).alias("first_price"),
        F.max_by("last_price", order).alias("last_price"),
        F.sum("quote_volume").alias("quote_volume_5m"),
        F.sum("trade_count").alias("trade_count_5m"),
        F.count("*").alias("record_count"),
        F.min("event_time").alias("first_event_time"),
        F.max("event_time").alias("last_event_time"),
        F.max("ingest_time").alias("last_ingest_time"),
    ]


def finish_windows(df: DataFrame, min_records: int) -> DataFrame:
    """Drop thin windows and derive return and latency."""
    return (
        df.where(F.col("record_count") >= min_records)
        .withColumns(
            {
                "return_5m": scoring.return_pct(F.col("first_price"), F.col("last_price")),
                "latency_ms": scoring.delay_ms(F.col("last_ingest_time"), F.col("last_event_time")),
            }
        )
        .select(*schemas.WINDOW.fieldNames())
    )


def event_windows(
    events: DataFrame,
    window: str = params.DEFAULT_WINDOW,
    min_records: int = params.DEFAULT_MIN_RECORDS,
    closed_before: int | None = None,
) -> DataFrame:
    """Aggregate events into tumbling windows of ``window`` per symbol.

    One shuffle on (symbol, window start), after map-side partial aggregation: a symbol with a
    third of all rows spreads over all its windows. ``closed_before`` drops windows that end after
    that epoch millisecond; by default the open last window counts.
    """
    length = params.duration_ms(window)
    windows = (
        events.withColumn("window_start", fn.aligned_start("event_time", length))
        .groupBy("symbol", "window_start")
        .agg(*measures(event_order(length)))
        .withColumn("window_end", F.col("window_start") + F.lit(length).cast("long"))
    )
    if closed_before is not None:
        windows = windows.where(F.col("window_end") <= closed_before)
    return finish_windows(windows, min_records)
