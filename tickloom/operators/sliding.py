"""Sliding windows that end at an event instead of an aligned bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom import params
from tickloom.functions import events as fn
from tickloom.functions.ordering import event_order
from tickloom.operators.dedupe import dedupe_trades
from tickloom.operators.latest import after_oldest_cutoff, newest_times, recent_events
from tickloom.session import materialise


def roll_up_events(events: DataFrame, min_records: int = params.DEFAULT_MIN_RECORDS) -> DataFrame:
    """One recent window per symbol out of its events, in the shape the scorer takes."""
    order = event_order()
    return (
        events.groupBy("symbol")
        .agg(
            F.min_by("last_price", order).alias("start_price"),
            F.max_by("last_price", order).alias("end_price"),
            F.sum("quote_volume").alias("quote_volume_5m"),
            F.sum("trade_count").alias("trade_count_5m"),
            F.count("*").alias("record_count"),
            F.min("event_time").alias("window_start"),
            F.max("event_time").alias("window_end"),
        )
        .where(F.col("record_count") >= min_records)
    )


def latest_sliding(
    events: DataFrame,
    window: str = params.DEFAULT_WINDOW,
    min_records: int = params.DEFAULT_MIN_RECORDS,
    dedupe: bool = False,
) -> DataFrame:
    """The window [newest - length, newest] of every symbol, both ends included.

    Two scans: the first reads two columns and leaves one row per symbol, the second keeps only
    the tail of each symbol and pre-aggregates it before the shuffle.
    """
    length = params.duration_ms(window)
    newest = materialise(newest_times(events), "newest")
    recent = recent_events(after_oldest_cutoff(events, newest, length), newest, length)
    return roll_up_events(dedupe_trades(recent) if dedupe else recent, min_records)


# Stretches that a block of one window length is cut into.
SUB_BLOCKS = 64
_TOTALS = ("volume", "trades", "records")


def _plus(one: Column, two: Column, name: str) -> Column:
    """Sum of a total of two parts, of which either may be missing."""
    return F.when(one.isNull(), two[name]).when(two.isNull(), one[name]).otherwise(one[name] + two[name])


def _joined(one: Column, two: Column) -> Column:
    """Totals of two parts of which the first lies before the second; null if both are missing."""
    front = F.coalesce(one, two)
    both = F.struct(
        front["price"].alias("price"),
        front["time"].alias("time"),
        *[_plus(one, two, name).alias(name) for name in _TOTALS],
    )
    return F.when(one.isNotNull() | two.isNotNull(), both)


def sliding_windows(events: DataFrame, window: str = params.DEFAULT_WINDOW) -> DataFrame:
    """For every event, its symbol's window [event_time - length, event_time].

    A RANGE frame would rebuild the aggregate of the whole window for each row, and a running sum
    that events enter and leave loses digits. Here the time line is cut into blocks of one length:
    a window is a suffix of one block and a prefix of the next, so running totals from either end of
    each block, added once, give every window in linear time and without a subtraction.

    Blocks are cut into ``SUB_BLOCKS`` stretches. Running totals inside a stretch and running totals of
    whole stretches, put together, are those of the block, so a task holds a stretch of a symbol, not
    its block. A window that ends in a stretch begins in the stretch of the same number of the block
    before. Events are summed per distinct time first, and those at the same time share one window, as
    under RANGE.
    """
    length = params.duration_ms(window)
    step = -(-length // SUB_BLOCKS)
    trade_id = F.coalesce("trade_id", F.lit(-1).cast("long"))
    order = F.struct(trade_id, F.col("last_price"))
    times = materialise(
        events.groupBy("symbol", "event_time").agg(
            F.min_by("last_price", order).alias("first_price"),
            F.max_by("last_price", order).alias("end_price"),
            F.sum("quote_volume").alias("volume"),
            F.sum("trade_count").alias("trades"),
            F.count("*").alias("records"),
        ),
        "times",
    )
    placed = times.withColumn("block", fn.aligned_start("event_time", length)).withColumn(
        "sub", F.floor((F.col("event_time") - F.col("block")) / step).cast("int")
    )

    # totals of the stretches before and after each one in its block
    stretches = placed.groupBy("symbol", "block", "sub").agg(
        F.struct(
            F.min_by("first_price", "event_time").alias("price"),
            F.min("event_time").alias("time"),
            *[F.sum(name).alias(name) for name in _TOTALS],
        ).alias("own")
    )
    # a stretch also asks for what follows the stretch of its number in the block before
    asking = stretches.select(
        "symbol",
        F.inline(
            F.array(
                F.struct(F.col("block"), F.col("sub"), F.lit(True).alias("real"), F.col("own")),
                F.struct(
                    (F.col("block") - F.lit(length).cast("long")).alias("block"),
                    F.col("sub"),
                    F.lit(False).alias("real"),
                    F.lit(None).cast(stretches.schema["own"].dataType).alias("own"),
                ),
            )
        ),
    )
    around = Window.partitionBy("symbol", "block")
    earlier = around.orderBy("sub").rangeBetween(Window.unboundedPreceding, -1)
    later = around.orderBy(F.desc("sub")).rangeBetween(Window.unboundedPreceding, -1)

    def total(frame, first) -> Column:
        whole = F.struct(
            first("own.price").alias("price"),
            first("own.time").alias("time"),
            *[F.sum(f"own.{name}").over(frame).alias(name) for name in _TOTALS],
        )
        return F.when(F.count("own").over(frame) > 0, whole)

    sides = asking.select(
        "symbol",
        "block",
        "sub",
        "real",
        total(earlier, lambda c: F.first(c, ignorenulls=True).over(earlier)).alias("earlier"),
        total(later, lambda c: F.last(c, ignorenulls=True).over(later)).alias("later"),
    )
    before_block = sides.where("NOT real").select(
        "symbol", (F.col("block") + F.lit(length).cast("long")).alias("block"), "sub", "later"
    )
    own_block = sides.where("real").select("symbol", "block", "sub", "earlier")
    borders = materialise(own_block.join(before_block, ["symbol", "block", "sub"]), "borders")

    # running totals inside a stretch
    part = Window.partitionBy("symbol", "block", "sub")
    upto = part.orderBy("event_time").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = part.orderBy(F.desc("event_time")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )

    def totals(frame) -> list:
        return [F.sum(c).over(frame).alias(c) for c in _TOTALS]

    sums = placed.select(
        "symbol",
        "block",
        "sub",
        "event_time",
        "end_price",
        F.struct(
            F.first("first_price").over(upto).alias("price"),
            F.first("event_time").over(upto).alias("time"),
            *totals(upto),
        ).alias("prefix"),
        F.struct(
            F.col("first_price").alias("price"), F.col("event_time").alias("time"), *totals(onward)
        ).alias("suffix"),
    )
    # A suffix serves the windows of the next block that begin at or before its first time.
    steps = sums.select(
        "symbol",
        "sub",
        F.inline(
            F.array(
                F.struct(
                    F.col("block"),
                    F.col("event_time").alias("at"),
                    F.lit(True).alias("own"),
                    F.col("end_price"),
                    F.col("prefix").alias("totals"),
                ),
                F.struct(
                    (F.col("block") + F.lit(length).cast("long")).alias("block"),
                    (F.col("event_time") + F.lit(length).cast("long")).alias("at"),
                    F.lit(False).alias("own"),
                    F.lit(None).cast("double").alias("end_price"),
                    F.col("suffix").alias("totals"),
                ),
            )
        ),
    )
    ahead = part.orderBy(F.desc("at"), F.asc("own")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    before = F.last(F.when(~F.col("own"), F.col("totals")), ignorenulls=True).over(ahead)
    inside = steps.withColumn("before", before).where("own").join(borders, ["symbol", "block", "sub"])
    front = _joined(F.col("before"), F.col("later"))
    back = _joined(F.col("earlier"), F.col("totals"))
    halves = inside.select("symbol", "at", "end_price", front.alias("front"), back.alias("back"))
    whole = halves.select("symbol", "at", "end_price", _joined(F.col("front"), F.col("back")).alias("all"))
    windows = whole.select(
        F.col("symbol").alias("w_symbol"),
        F.col("at").alias("w_time"),
        F.col("all.price").alias("start_price"),
        "end_price",
        F.col("all.volume").alias("quote_volume_5m"),
        F.col("all.trades").alias("trade_count_5m"),
        F.col("all.records").alias("record_count"),
        F.col("all.time").alias("window_start"),
    )
    same = (F.col("symbol") == F.col("w_symbol")) & (F.col("event_time") == F.col("w_time"))
    return (
        events.select("symbol", "event_time", "trade_id")
        .join(windows, same)
        .drop("w_symbol", "w_time")
        .withColumn("window_end", F.col("event_time"))
    )
