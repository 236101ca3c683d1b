"""Parquet, JSON and CSV outputs of the batch and serving layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import params, schemas
from tickloom.functions import events as fn
from tickloom.operators.baselines import tagged
from tickloom.session import materialise


def write_windows(windows: DataFrame, path: str) -> None:
    """Windows as Parquet by symbol.

    The rebalance hint puts a symbol's rows together, so few files are written per folder, and
    lets adaptive execution split a symbol too large for one file.
    """
    windows.hint("rebalance", "symbol").write.mode("overwrite").partitionBy("symbol").parquet(path)


def read_windows(spark, path: str) -> DataFrame:
    return spark.read.schema(schemas.WINDOW).parquet(path).select(*schemas.WINDOW.fieldNames())


def write_baselines(baseline_rows: DataFrame, path: str) -> None:
    tagged(baseline_rows).write.mode("overwrite").parquet(path)


def write_baselines_json(baseline_rows: DataFrame, path: str, one_part: bool = False) -> None:
    """Baselines as JSON Lines, in one part only if asked for."""
    rows = tagged(baseline_rows)
    (rows.repartition(1) if one_part else rows).write.mode("overwrite").json(path)


def baseline_envelope(baseline_rows: DataFrame, generated_at: str) -> DataFrame:
    """Lines of one JSON document that holds all baselines, in order: columns part, symbol, line.

    The document is put together line by line, so no task has to hold it.
    """
    rows = materialise(
        baseline_rows.select("symbol", fn.canonical_json(schemas.BASELINE.fieldNames()).alias("line")),
        "envelope",
    )
    first = rows.agg(F.min("symbol").alias("symbol"))
    comma = F.when(F.col("symbol") == first.scalar(), F.lit("")).otherwise(F.lit(","))
    body = rows.select(F.lit(1).alias("part"), "symbol", F.concat(comma, "line").alias("line"))
    frame = first.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit(0).alias("part"),
                    F.lit("").alias("symbol"),
                    F.lit(
                        f'{{"schema_version":{params.SCHEMA_VERSION},"generated_at":"{generated_at}",'
                        '"view_type":"batch_baseline","baselines":['
                    ).alias("line"),
                ),
                F.struct(
                    F.lit(2).alias("part"), F.lit("").alias("symbol"), F.lit("]}").alias("line")
                ),
            )
        )
    )
    return frame.unionByName(body)


def write_baseline_envelope(baseline_rows: DataFrame, path: str, generated_at: str) -> None:
    lines = baseline_envelope(baseline_rows, generated_at)
    lines.repartition(1).sortWithinPartitions("part", "symbol").select("line").write.mode(
        "overwrite"
    ).text(path)


def snapshot_document(trending: DataFrame, spikes: DataFrame) -> DataFrame:
    """One row with the JSON document of two top-n lists, in order of their rank columns.

    Both lists are limited to the rows a reader sees, so the document stays small. They are gathered
    by one aggregation, without a join.
    """

    def items(rows: DataFrame, rank: str, name: str) -> DataFrame:
        columns = [column for column in rows.columns if column not in ("rank", "spike_rank")]
        return rows.select(F.struct(F.col(rank).alias("place"), F.struct(*sorted(columns)).alias("row")).alias(name))

    def listed(name: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(name)), lambda entry: entry["row"]).alias(name)

    both = items(trending, "rank", "trending").unionByName(
        items(spikes, "spike_rank", "spikes"), allowMissingColumns=True
    )
    return both.agg(listed("spikes"), listed("trending")).select(
        F.to_json(F.struct("spikes", "trending"), {"ignoreNullFields": "false"}).alias("value")
    )


def write_events_by_day(events: DataFrame, path: str) -> None:
    """Backfill output: compact gzip JSON with sorted keys, a folder per symbol and day.

    ``symbol`` stays in the payload. The rebalance hint splits a large symbol-day over several files.
    Only folders that get rows are replaced.
    """
    columns = sorted(name for name in events.columns if name != "event_timestamp")
    day = F.to_date(F.timestamp_millis("event_time"))
    (
        events.select(
            F.to_json(F.struct(*columns)).alias("value"),
            F.col("symbol").alias("_symbol"),
            day.alias("_date"),
        )
        .withColumnsRenamed({"_symbol": "symbol", "_date": "date"})
        .hint("rebalance", "symbol", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("symbol", "date")
        .option("compression", "gzip")
        .text(path)
    )


def write_event_table(events: DataFrame, path: str) -> None:
    """Canonical events as Parquet by date and symbol, which readers prune.

    Dates and symbols that are written again are replaced, all others stay. The rebalance hint splits
    a large symbol-day over several files.
    """
    (
        events.select(
            *schemas.EVENT_COLUMNS, F.to_date(F.timestamp_millis("event_time")).alias("date")
        )
        .hint("rebalance", "date", "symbol")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "symbol")
        .parquet(path)
    )


def write_json_lines(events: DataFrame, path: str) -> None:
    """Append canonical JSON Lines."""
    columns = sorted(name for name in schemas.EVENT_COLUMNS if name in events.columns)
    events.select(*columns).write.mode("append").json(path)


def write_quarantine(bad: DataFrame, path: str) -> None:
    """Raw text of malformed lines, apart from the good ones."""
    bad.select("raw").write.mode("append").text(path)


def write_log(rows: DataFrame, path: str) -> None:
    """Metric log as CSV with a heading."""
    rows.write.mode("overwrite").option("header", "true").csv(path)
