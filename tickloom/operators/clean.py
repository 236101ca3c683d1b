"""Cleaning of raw events into the canonical event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import events as fn


def with_defaults(df: DataFrame) -> DataFrame:
    """Fill the optional fields of an event the way lenient ingest does."""
    return df.withColumns(
        {
            "quote_volume": F.coalesce("quote_volume", F.lit(0.0)),
            "trade_count": F.coalesce("trade_count", F.lit(1).cast("long")),
            "ingest_time": F.coalesce("ingest_time", "event_time"),
        }
    )


def valid_event() -> Column:
    return (
        F.col("symbol").isNotNull()
        & F.col("event_time").isNotNull()
        & (F.col("last_price") > 0)
        & (F.col("quote_volume") >= 0)
    )


def clean_events(df: DataFrame, lenient: bool = False) -> DataFrame:
    """Valid events with upper-case symbol and millisecond clocks.

    ``lenient`` fills missing volume, count and ingest time instead of dropping the row. The
    predicates reach the scan when the input is Parquet.
    """
    source = with_defaults(df) if lenient else df
    kept = source.where(valid_event()).withColumns(
        {
            "symbol": F.upper("symbol"),
            "event_time": fn.epoch_millis("event_time"),
            "ingest_time": fn.epoch_millis("ingest_time"),
        }
    )
    return kept.withColumns(
        {
            "base_asset": fn.base_asset("symbol"),
            "event_timestamp": F.timestamp_millis("event_time"),
        }
    )


def restrict_symbols(df: DataFrame, wanted: DataFrame | list[str] | tuple[str, ...]) -> DataFrame:
    """Rows whose symbol is in a short list, or in the ``symbol`` column of another frame."""
    if isinstance(wanted, DataFrame):
        return df.join(wanted.select("symbol"), "symbol", "left_semi")
    return df.where(F.col("symbol").isin(*wanted))


def spot_events(df: DataFrame, allow: tuple[str, ...] = ()) -> DataFrame:
    return df.where(fn.is_spot_symbol("symbol", allow))
