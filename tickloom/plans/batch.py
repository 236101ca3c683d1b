"""The full-history batch job: events to windows to baselines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tickloom import params
from tickloom.operators.baselines import baselines
from tickloom.operators.clean import clean_events
from tickloom.operators.dedupe import dedupe_trades
from tickloom.operators.windows import event_windows
from tickloom.session import materialise
from tickloom.sinks import tables
from tickloom.sources.events import read_event_table, read_events


@dataclass(frozen=True)
class BatchViews:
    windows: DataFrame
    baselines: DataFrame


def batch_views(
    events: DataFrame,
    updated_at: str,
    window: str = params.DEFAULT_WINDOW,
    min_records: int = params.DEFAULT_MIN_RECORDS,
    median: str = "exact",
    windows_path: str | None = None,
    dedupe: bool = False,
) -> BatchViews:
    """Windows and baselines of raw events; ``dedupe`` counts a repeated trade once.

    The events are scanned once: the windows are written (to ``windows_path`` if given, else to
    the shared folder) and everything after reads that far smaller table.
    """
    clean = clean_events(events)
    fresh = event_windows(dedupe_trades(clean) if dedupe else clean, window, min_records)
    if windows_path is None:
        windows = materialise(fresh, "windows")
    else:
        tables.write_windows(fresh, windows_path)
        windows = tables.read_windows(events.sparkSession, windows_path)
    return BatchViews(windows, baselines(windows, updated_at, median))


def run_batch(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    updated_at: str,
    json_output: str | None = None,
    batch_view_output: str | None = None,
    window: str = params.DEFAULT_WINDOW,
    min_records: int = params.DEFAULT_MIN_RECORDS,
    median: str = "exact",
    dedupe: bool = False,
    event_table: bool = False,
) -> None:
    """Publish the batch views of a JSON Lines archive, or of a Parquet table of events."""
    views = batch_views(
        read_event_table(spark, input_path) if event_table else read_events(spark, input_path),
        updated_at,
        window,
        min_records,
        median,
        batch_view_output,
        dedupe,
    )
    rows = materialise(views.baselines, "baselines")
    tables.write_baselines(rows, output_path)
    if json_output is not None:
        tables.write_baselines_json(rows, json_output)
