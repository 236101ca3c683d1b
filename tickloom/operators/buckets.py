"""Compact time buckets: the mergeable state behind the recent window of a symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom import params, schemas
from tickloom.functions import events as fn
from tickloom.functions.ordering import event_order
from tickloom.operators.latest import after_oldest_cutoff, newest_times
from tickloom.session import materialise

_COLUMNS = schemas.SYMBOL_BUCKET.fieldNames()


def time_buckets(
    events: DataFrame, bucket_ms: int = params.DEFAULT_BUCKET_MS
) -> DataFrame:
    """Events summed per (symbol, bucket), with the first and last event of each bucket."""
    order = event_order(bucket_ms)
    trade_id = F.coalesce("trade_id", F.lit(-1).cast("long"))
    return (
        events.withColumn("bucket_start", fn.aligned_start("event_time", bucket_ms))
        .groupBy("symbol", "bucket_start")
        .agg(
            F.min("event_time").alias("first_event_time"),
            F.max("event_time").alias("last_event_time"),
            F.min_by(trade_id, order).alias("first_trade_id"),
            F.max_by(trade_id, order).alias("last_trade_id"),
            F.min_by("last_price", order).alias("first_price"),
            F.max_by("last_price", order).alias("last_price"),
            F.sum("quote_volume").alias("quote_volume"),
            F.sum("trade_count").alias("trade_count"),
        )
        .select(*_COLUMNS)
    )


def merge_buckets(*parts: DataFrame) -> DataFrame:
    """Combine bucket sets; the order and grouping of the parts does not matter."""
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    first = F.struct("first_event_time", "first_trade_id", "first_price")
    last = F.struct("last_event_time", "last_trade_id", "last_price")
    return (
        together.groupBy("symbol", "bucket_start")
        .agg(
            F.min(first).alias("first"),
            F.max(last).alias("last"),
            F.sum("quote_volume").alias("quote_volume"),
            F.sum("trade_count").alias("trade_count"),
        )
        .select("symbol", "bucket_start", "first.*", "last.*", "quote_volume", "trade_count")
        .select(*_COLUMNS)
    )


def retain_recent(
    buckets: DataFrame, window_ms: int, newest: DataFrame | None = None
) -> DataFrame:
    """Buckets whose last event lies within ``window_ms`` of the newest one of the symbol.

    A bucket across the cutoff stays whole. Pass a written table, it is read twice.
    """
    if newest is None:
        newest = materialise(newest_times(buckets, "last_event_time"), "newest")
    return (
        buckets.join(newest, "symbol")
        .where(F.col("last_event_time") >= F.col("newest") - F.lit(window_ms).cast("long"))
        .select(*_COLUMNS)
    )


def roll_up_buckets(
    buckets: DataFrame, min_buckets: int = params.DEFAULT_MIN_RECORDS
) -> DataFrame:
    """One recent window per symbol out of its buckets, in the shape the scorer takes."""
    return (
        buckets.groupBy("symbol")
        .agg(
            F.min_by("first_price", "bucket_start").alias("start_price"),
            F.max_by("last_price", "bucket_start").alias("end_price"),
            F.sum("quote_volume").alias("quote_volume_5m"),
            F.sum("trade_count").alias("trade_count_5m"),
            F.count("*").alias("bucket_count"),
            F.min_by("first_event_time", "bucket_start").alias("window_start"),
            F.max_by("last_event_time", "bucket_start").alias("window_end"),
        )
        .where(F.col("bucket_count") >= min_buckets)
    )


def latest_bucket_window(
    events: DataFrame,
    window: str = params.DEFAULT_WINDOW,
    bucket_ms: int = params.DEFAULT_BUCKET_MS,
    min_buckets: int = params.DEFAULT_MIN_RECORDS,
) -> DataFrame:
    """Recent window per symbol at bucket grain.

    Events are first cut to the tail of their symbol plus one bucket, which keeps every bucket
    that can survive the cutoff complete; only that tail is bucketed.
    """
    length = params.duration_ms(window)
    newest = materialise(newest_times(events), "newest")
    cutoff = F.col("newest") - F.lit(length).cast("long")
    tail = (
        after_oldest_cutoff(events, newest, length + bucket_ms)
        .join(newest, "symbol")
        .where(F.col("event_time") >= fn.aligned_start(cutoff, bucket_ms))
        .drop("newest")
    )
    recent = retain_recent(time_buckets(tail, bucket_ms), length, newest)
    return roll_up_buckets(recent, min_buckets)


def bucket_state(buckets: DataFrame, checkpoints: DataFrame | None = None) -> DataFrame:
    """One state row per symbol: its buckets in order, its checkpoints and its newest time.

    ``buckets`` must be cut to the recent window first, so a row holds at most one element per
    bucket of that window. ``checkpoints`` has symbol, shard and sequence.
    """
    fields = schemas.BUCKET.fieldNames()
    state = buckets.groupBy("symbol").agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("buckets"),
        F.max("last_event_time").alias("newest_event_time"),
    )
    empty = F.create_map().cast("map<string,string>")
    if checkpoints is None:
        state = state.withColumn("checkpoints", empty)
    else:
        entries = checkpoints.groupBy("symbol").agg(
            F.map_from_entries(
                F.array_sort(F.collect_list(F.struct("shard", "sequence")))
            ).alias("checkpoints")
        )
        state = state.join(entries, "symbol", "left").withColumn(
            "checkpoints", F.coalesce("checkpoints", empty)
        )
    return state.select(*schemas.BUCKET_STATE.fieldNames())


def explode_state(state: DataFrame) -> DataFrame:
    """Back from state rows to one row per bucket."""
    return state.select("symbol", F.inline("buckets"))
