"""Newest row and newest time per symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom import params
from tickloom.functions import events as fn
from tickloom.functions.ordering import event_order


def latest_rows(events: DataFrame, columns: tuple[str, ...], grain: str = "1 hour") -> DataFrame:
    """The given columns of the newest event per symbol, by (event time, trade id, price).

    The newest row is first found per (symbol, ``grain``) and then per symbol; both steps
    hash-aggregate, and a busy symbol spreads over its hours.
    """
    length = params.duration_ms(grain)
    order = event_order(length)
    slots = (
        events.withColumn("slot", fn.aligned_start("event_time", length))
        .groupBy("symbol", "slot")
        .agg(*[F.max_by(name, order).alias(name) for name in columns])
    )
    return slots.groupBy("symbol").agg(*[F.max_by(name, "slot").alias(name) for name in columns])


def newest_times(df: DataFrame, time: str = "event_time") -> DataFrame:
    return df.groupBy("symbol").agg(F.max(time).alias("newest"))


def newest_overall(df: DataFrame, time: str = "window_end") -> DataFrame:
    """One row with the largest value of ``time``."""
    return df.agg(F.max(time).alias("newest"))


def after_oldest_cutoff(events: DataFrame, newest: DataFrame, span_ms: int) -> DataFrame:
    """Drop events before the earliest cutoff of any symbol.

    The bound is one number, so the scan itself can skip old files and row groups. ``newest`` must
    be a written table.
    """
    oldest = newest.agg(F.min("newest")).scalar()
    return events.where(F.col("event_time") >= oldest - F.lit(span_ms).cast("long"))


def recent_events(events: DataFrame, newest: DataFrame, window_ms: int) -> DataFrame:
    """Events within ``window_ms`` of the newest one of their symbol, both ends included.

    ``newest`` should be a written table: a map-side broadcast join filters the events without
    moving them as long as that table is small, and it is not forced when it is large.
    """
    return (
        events.join(newest, "symbol")
        .where(F.col("event_time") >= F.col("newest") - F.lit(window_ms).cast("long"))
        .drop("newest")
    )
