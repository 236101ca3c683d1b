"""Stream outputs that keep events as files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom import schemas
from tickloom.functions import events as fn


def _trigger(every: str | None) -> dict[str, object]:
    return {"availableNow": True} if every is None else {"processingTime": every}


def archive_events(
    events: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = "60 seconds",
    writers: int = 4,
) -> StreamingQuery:
    """Raw archive: gzip JSON Lines in folders by date, hour and symbol of the payload.

    Each folder gets at most ``writers`` files per micro-batch, written by that many tasks, so
    files stay few and a symbol with most of the traffic is not left to one task. The number of
    tasks is given, else adaptive execution would join small batches into one slow writer.
    """
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [name for name in schemas.EVENT_COLUMNS if name in events.columns]
    clock = F.timestamp_millis(fn.epoch_millis("event_time"))
    return (
        events.select(
            fn.canonical_json(columns).alias("value"),
            F.date_format(clock, "yyyy-MM-dd").alias("date"),
            F.date_format(clock, "HH").alias("hour"),
            F.upper("symbol").alias("symbol"),
            F.pmod(F.hash(F.coalesce("trade_id", "ingest_time")), F.lit(writers)).alias("writer"),
        )
        .repartition(tasks, "date", "hour", "symbol", "writer")
        .drop("writer")
        .writeStream.partitionBy("date", "hour", "symbol")
        .option("compression", "gzip")
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .format("text")
        .start(path)
    )


def append_json_lines(
    events: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Canonical JSON Lines, appended."""
    columns = sorted(name for name in schemas.EVENT_COLUMNS if name in events.columns)
    return (
        events.select(*columns)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .format("json")
        .start(path)
    )


def append_quarantine(
    bad: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Raw text of malformed lines, apart from the good ones."""
    return (
        bad.select("raw")
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .format("text")
        .start(path)
    )


def print_events(events: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
    columns = [name for name in schemas.EVENT_COLUMNS if name in events.columns]
    return (
        events.select(fn.canonical_json(columns).alias("value"))
        .writeStream.option("checkpointLocation", checkpoint)
        .option("truncate", "false")
        .trigger(**_trigger(every))
        .format("console")
        .start()
    )
