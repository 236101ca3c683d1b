"""Recent windows per symbol in Spark's own keyed state.

State is a map by symbol inside groups of symbols, so that Python is called once for each group of a
micro-batch and not for each symbol. A micro-batch reads and writes the entries of the symbols it has
rows for and of no others. State lies in the checkpoint of the stream, versioned by micro-batch, so a
batch that runs again after a failure starts from the same state. With a retention the entry of a silent
symbol expires by itself.

Every step gives, for each symbol of the micro-batch, its recent window in the shape the scorer takes,
with ``records``, the number of events or buckets in it. ``stored_buckets``, ``stored_checkpoints`` and
``stored_records`` read the state itself out of a checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom import params, schemas
from tickloom.operators import buckets as bk
from tickloom.session import reach_workers

WINDOW = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("start_price", T.DoubleType()),
        T.StructField("end_price", T.DoubleType()),
        T.StructField("quote_volume_5m", T.DoubleType()),
        T.StructField("trade_count_5m", T.LongType()),
        T.StructField("records", T.LongType()),
        T.StructField("window_start", T.LongType()),
        T.StructField("window_end", T.LongType()),
    ]
)
_SYMBOL = T.StructType([T.StructField("symbol", T.StringType())])
_SEQUENCE = T.StructType([T.StructField("sequence", T.StringType())])
# Groups of symbols; choose several times the number of shuffle partitions. A stream keeps its number.
GROUPS = 32
# An event in its order inside a window; an id that is missing is -1, as in buckets.
_RECORD = T.StructType(
    [
        T.StructField("event_time", T.LongType()),
        T.StructField("trade_id", T.LongType()),
        T.StructField("last_price", T.DoubleType()),
        T.StructField("quote_volume", T.DoubleType()),
        T.StructField("trade_count", T.LongType()),
        T.StructField("has_id", T.BooleanType()),
    ]
)
_BUCKETS = schemas.SYMBOL_BUCKET.fieldNames()
_HELD_BUCKETS = T.StructType([T.StructField("buckets", T.ArrayType(schemas.BUCKET))])
_HELD_RECORDS = T.StructType([T.StructField("records", T.ArrayType(_RECORD))])
# Buckets of one range are put together by one task before they meet the state of their symbol.
RANGE_BUCKETS = 64


def _rows(frames: Iterable[pd.DataFrame], names: list[str]) -> Iterator[tuple]:
    for frame in frames:
        yield from zip(*[frame[name].tolist() for name in names])


def _frame(rows: list[tuple], schema: T.StructType) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=schema.fieldNames())


def _is_number(text: str) -> bool:
    return text.isascii() and text.isdigit()


def sequence_after(sequence: str, previous: str | None) -> bool:
    """The rule of ``operators.replay.sequence_after`` for one value."""
    if previous is None:
        return True
    if _is_number(sequence) and _is_number(previous):
        return int(sequence) > int(previous)
    return sequence > previous


def _sequence_order(sequence: str) -> tuple:
    return (0, int(sequence), sequence) if _is_number(sequence) else (1, 0, sequence)


def _merged(one: tuple, two: tuple) -> tuple:
    """Two parts of a bucket (first time, id, price, last time, id, price, volume, trades)."""
    return (*min(one[:3], two[:3]), *max(one[3:6], two[3:6]), one[6] + two[6], one[7] + two[7])


_FRESH = T.StructType([*schemas.SYMBOL_BUCKET.fields, T.StructField("symbols", T.IntegerType())])


def _by_symbol(rows: Iterable[tuple]) -> dict[str, list[tuple]]:
    out: dict[str, list[tuple]] = {}
    for symbol, *row in rows:
        out.setdefault(symbol, []).append(tuple(row))
    return out


class FreshBuckets(StatefulProcessor):
    """Records of one (lane, group of symbols) to their buckets of this micro-batch, without replays.

    The state is the largest sequence seen of each symbol. A record counts if its sequence is beyond the
    state before the micro-batch, and once if it is there several times.
    """

    def __init__(self, bucket_ms: int, ttl_ms: int | None) -> None:
        self.bucket_ms, self.ttl_ms = bucket_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.reached = handle.getMapState("checkpoint", _SYMBOL, _SEQUENCE, self.ttl_ms)

    def _new(self, symbol: str, rows: list[tuple]) -> list[tuple]:
        new: list[tuple] = []
        by_sequence: dict[str, tuple] = {}
        for *event, sequence in rows:
            row = tuple(event)
            if sequence is None:
                new.append(row)
            elif sequence not in by_sequence or row < by_sequence[sequence]:
                by_sequence[sequence] = row
        if by_sequence:
            held = self.reached.getValue((symbol,))
            previous = held[0] if held else None
            fresh = [s for s in by_sequence if sequence_after(s, previous)]
            if fresh:
                known = fresh if previous is None else [*fresh, previous]
                self.reached.updateValue((symbol,), (max(known, key=_sequence_order),))
            new += [by_sequence[s] for s in fresh]
        return new

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = ["symbol", "event_time", "trade_id", "last_price", "quote_volume", "trade_count", "sequence"]
        out = []
        for symbol, own in _by_symbol(_rows(rows, names)).items():
            found: dict[int, tuple] = {}
            for time, trade, price, volume, trades in self._new(symbol, own):
                event = (time, trade, price)
                part = (*event, *event, volume, trades)
                start = time - time % self.bucket_ms
                found[start] = _merged(found[start], part) if start in found else part
            out += [
                (symbol, start, first, last, first_id, last_id, first_price, last_price, volume, trades, key[1])
                for start, (first, first_id, first_price, last, last_id, last_price, volume, trades) in found.items()
            ]
        if out:
            yield _frame(out, _FRESH)

    def close(self) -> None:
        pass


def _bucket_parts(rows: Iterable[tuple]) -> Iterator[tuple[int, tuple]]:
    for start, first, last, first_id, last_id, first_price, last_price, volume, trades in rows:
        yield start, (first, first_id, first_price, last, last_id, last_price, volume, trades)


class RecentBuckets(StatefulProcessor):
    """Buckets of a symbol's recent window as state, at most one for each bucket of that window."""

    def __init__(self, length: int, bucket_ms: int, ttl_ms: int | None) -> None:
        self.length, self.bucket_ms, self.ttl_ms = length, bucket_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buckets = handle.getMapState("buckets", _SYMBOL, _HELD_BUCKETS, self.ttl_ms)

    def _window(self, symbol: str, rows: list[tuple]) -> tuple:
        stored = self.buckets.getValue((symbol,))
        held = dict(_bucket_parts(stored[0] if stored else ()))
        for start, part in _bucket_parts(rows):
            held[start] = _merged(held[start], part) if start in held else part
        cutoff = max(part[3] for part in held.values()) - self.length
        # Whole buckets from the cutoff's own on, whatever they hold yet: an event that arrives
        # late into that bucket must still find it, in any order of arrival.
        kept = sorted((s, p) for s, p in held.items() if s >= cutoff - cutoff % self.bucket_ms)
        entry = [(s, p[0], p[3], p[1], p[4], p[2], p[5], p[6], p[7]) for s, p in kept]
        self.buckets.updateValue((symbol,), (entry,))
        inside = [part for _, part in kept if part[3] >= cutoff]
        first, last = inside[0], inside[-1]
        volume, trades = sum(p[6] for p in inside), sum(p[7] for p in inside)
        return (symbol, first[2], last[5], volume, trades, len(inside), first[0], last[3])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        own = _by_symbol(_rows(rows, _BUCKETS))
        yield _frame([self._window(symbol, parts) for symbol, parts in own.items()], WINDOW)

    def close(self) -> None:
        pass


class RecentRecords(StatefulProcessor):
    """Events of a symbol's recent window as state, each trade id once, those without id all."""

    def __init__(self, length: int, ttl_ms: int | None) -> None:
        self.length, self.ttl_ms = length, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.records = handle.getMapState("records", _SYMBOL, _HELD_RECORDS, self.ttl_ms)

    def _window(self, symbol: str, rows: list[tuple]) -> tuple:
        stored = self.records.getValue((symbol,))
        together = [*map(tuple, stored[0] if stored else ()), *rows]
        cutoff = max(row[0] for row in together) - self.length
        once: dict[int, tuple] = {}
        anonymous: list[tuple] = []
        for row in together:
            if row[0] < cutoff:
                continue
            if not row[-1]:
                anonymous.append(row)
            elif row[1] not in once or row < once[row[1]]:
                once[row[1]] = row
        kept = [*once.values(), *anonymous]
        self.records.updateValue((symbol,), (kept,))
        first, last = min(kept), max(kept)
        volume, trades = sum(row[3] for row in kept), sum(row[4] for row in kept)
        return (symbol, first[2], last[2], volume, trades, len(kept), first[0], last[0])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        own = _by_symbol(_rows(rows, ["symbol", *_RECORD.fieldNames()]))
        yield _frame([self._window(symbol, events) for symbol, events in own.items()], WINDOW)

    def close(self) -> None:
        pass


def _mode(retention_seconds: int | None) -> tuple[int | None, str]:
    return (None, "None") if retention_seconds is None else (retention_seconds * 1000, "ProcessingTime")


def _measured(events: DataFrame, groups: int, *more: Column) -> DataFrame:
    """What the state needs of an event; ids never null, so that they stay whole numbers in pandas."""
    return events.select(
        "symbol",
        "event_time",
        F.coalesce("trade_id", F.lit(-1).cast("long")).alias("trade_id"),
        "last_price",
        "quote_volume",
        "trade_count",
        F.col("trade_id").isNotNull().alias("has_id"),
        F.pmod(F.xxhash64("symbol"), F.lit(groups)).cast("int").alias("symbols"),
        *more,
    )


def recent_bucket_windows(
    events: DataFrame,
    window: str = params.DEFAULT_WINDOW,
    bucket_ms: int = params.DEFAULT_BUCKET_MS,
    retention_seconds: int | None = None,
    groups: int = GROUPS,
) -> DataFrame:
    """Recent windows out of time buckets, two stateful steps in one stream.

    Sharded records (``_shard_id``, ``_sequence``) are freed of replays and put into buckets by shard and
    group of symbols, plain events by range of buckets and group, so a symbol with most of the traffic
    spreads over many keys and reaches its own state as one row per key and bucket.
    """
    reach_workers(events.sparkSession)
    ttl, mode = _mode(retention_seconds)
    sharded = "_shard_id" in events.columns
    stretch = F.lit(RANGE_BUCKETS * bucket_ms).cast("long")
    lane = F.coalesce("_shard_id", F.lit("")) if sharded else (F.expr("event_time") / stretch).cast("long")
    sequence = F.col("_sequence") if sharded else F.lit(None)
    lanes = _measured(events, groups, lane.cast("string").alias("lane"), sequence.cast("string").alias("sequence"))
    fresh = lanes.groupBy("lane", "symbols").transformWithStateInPandas(
        FreshBuckets(bucket_ms, ttl), _FRESH, "Append", mode
    )
    return fresh.groupBy("symbols").transformWithStateInPandas(
        RecentBuckets(params.duration_ms(window), bucket_ms, ttl), WINDOW, "Append", mode
    )


def recent_record_windows(
    events: DataFrame,
    window: str = params.DEFAULT_WINDOW,
    retention_seconds: int | None = None,
    groups: int = GROUPS,
) -> DataFrame:
    """Recent windows out of single events, exact to the millisecond.

    A symbol's events of one window are one state; buckets are the form for busy symbols.
    """
    reach_workers(events.sparkSession)
    ttl, mode = _mode(retention_seconds)
    return (
        _measured(events, groups)
        .groupBy("symbols")
        .transformWithStateInPandas(
            RecentRecords(params.duration_ms(window), ttl), WINDOW, "Append", mode
        )
    )


def _stored(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """The state ``variable`` of the last micro-batch of a stream."""
    known = spark.read.format("state-metadata").load(checkpoint).collect()
    # one row per stateful operator of the query
    (operator,) = {
        row["operatorId"] for row in known if f'"{variable}"' in (row["operatorProperties"] or "")
    }
    held = (
        spark.read.format("statestore")
        .option("operatorId", operator)
        .option("stateVarName", variable)
        .load(checkpoint)
    )
    # next to an entry that expires stands when
    if "ttlExpirationMs" in held.schema["user_map_value"].dataType.names:
        held = held.withColumn("user_map_value", F.col("user_map_value.value"))
    return held


def stored_buckets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(symbol, bucket): the buckets that the state holds."""
    held = _stored(spark, checkpoint, "buckets")
    return held.select("user_map_key.symbol", F.inline("user_map_value.buckets")).select(*_BUCKETS)


def stored_records(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The events that the state holds, as far as a window needs them."""
    return _stored(spark, checkpoint, "records").select("user_map_key.symbol", F.inline("user_map_value.records"))


def stored_checkpoints(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(symbol, shard, sequence) reached by the records of a stream."""
    held = _stored(spark, checkpoint, "checkpoint")
    return held.select("user_map_key.symbol", F.col("key.lane").alias("shard"), "user_map_value.sequence")


def stored_state(spark: SparkSession, checkpoint: str, window: str, bucket_ms: int) -> DataFrame:
    """One row per symbol: the buckets of its recent window, checkpoints, newest time."""
    recent = bk.retain_recent(stored_buckets(spark, checkpoint), params.duration_ms(window))
    return bk.bucket_state(recent, stored_checkpoints(spark, checkpoint))

