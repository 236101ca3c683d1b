"""Streaming forms of the window aggregate and of duplicate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom import params
from tickloom.functions.ordering import event_order
from tickloom.operators.windows import finish_windows, measures


def stream_windows(
    events: DataFrame,
    window: str = params.DEFAULT_WINDOW,
    lateness: str = params.DEFAULT_WINDOW,
    min_records: int = params.DEFAULT_MIN_RECORDS,
) -> DataFrame:
    """Tumbling windows of a cleaned event stream, with the columns of the batch windows.

    State is kept per (symbol, window), so a busy symbol spreads over the state partitions only as
    its windows do, but its rows are pre-aggregated before they get there.
    """
    order = event_order(params.duration_ms(window))
    slot = F.window("event_timestamp", window).alias("slot")
    windows = (
        events.withWatermark("event_timestamp", lateness)
        .groupBy("symbol", slot)
        .agg(*measures(order))
        .withColumns(
            {
                "window_start": F.unix_millis("slot.start"),
                "window_end": F.unix_millis("slot.end"),
            }
        )
    )
    return finish_windows(windows, min_records)


def stream_dedupe(events: DataFrame, horizon: str = params.DEFAULT_WINDOW) -> DataFrame:
    """Each trade id once per symbol within the horizon; rows without an id all pass."""
    with_id = (
        events.where(F.col("trade_id").isNotNull())
        .withWatermark("event_timestamp", horizon)
        .dropDuplicatesWithinWatermark(["symbol", "trade_id"])
    )
    return with_id.unionByName(events.where(F.col("trade_id").isNull()))
