"""Baselines kept up to date by day: mergeable partial states per symbol and day.

A state has the number of a day's windows and, for each measure, mean and sum of squared deviations,
which merge exactly but for rounding, and a quantile sketch of the volume for the median. A new or
corrected day reads that day's events and replaces that day's states; baselines are merged out of the
states, one small row per symbol and day, without the events of any other day.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import params, schemas
from tickloom.operators.clean import clean_events
from tickloom.operators.windows import event_windows
from tickloom.sources.events import read_event_table

MEASURES = ("return_5m", "quote_volume_5m", "trade_count_5m")
VOLUME = "quote_volume_5m"
# Size of the sketches, and a bound on the error of a median's rank for that size, after any merging.
SKETCH_K = 800
MEDIAN_RANK_ERROR = 0.01


def _moments(measure: str) -> Column:
    value = F.col(measure).cast("double")
    return F.struct(
        F.count(value).cast("double").alias("n"),
        F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count(value)).alias("m2"),
    ).alias(measure)


def daily_states(windows: DataFrame) -> DataFrame:
    """(symbol, date, n, the measures' moments, sketch) of windows that lie within a day each."""
    day = F.to_date(F.timestamp_millis("window_start")).alias("date")
    return windows.groupBy("symbol", day).agg(
        F.count(F.lit(1)).alias("n"),
        *[_moments(measure) for measure in MEASURES],
        F.kll_sketch_agg_double(VOLUME, SKETCH_K).alias("sketch"),
    )


def _merge(one: Column, two: Column) -> Column:
    """Moments of two sets put together."""
    n = one["n"] + two["n"]
    apart = two["mean"] - one["mean"]
    return F.struct(
        n.alias("n"),
        (one["mean"] + apart * two["n"] / n).alias("mean"),
        (one["m2"] + two["m2"] + apart * apart * one["n"] * two["n"] / n).alias("m2"),
    )


def merged_baselines(states: DataFrame, updated_at: str) -> DataFrame:
    """Baselines out of daily states, with the sketch's median.

    A symbol's moments, one small entry a day, are merged in the order of days, so the result does not
    depend on how the rows arrive.
    """
    empty = F.struct(*[F.lit(0.0).alias(name) for name in ("n", "mean", "m2")])
    days = states.groupBy("symbol").agg(
        F.array_sort(F.collect_list(F.struct("date", *MEASURES))).alias("days"),
        F.sum("n").alias("sample_count"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )
    merged = days.select(
        "symbol",
        "sample_count",
        F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)).alias(f"median_{VOLUME}"),
        *[
            F.aggregate(F.col(f"days.{measure}"), empty, _merge).alias(measure) for measure in MEASURES
        ],
    )
    spread = lambda m: F.when(m["n"] > 1, F.sqrt(m["m2"] / (m["n"] - 1))).otherwise(0.0)
    columns = {}
    for measure in MEASURES:
        columns[f"mean_{measure}"] = F.col(measure)["mean"]
        columns[f"std_{measure}"] = spread(F.col(measure))
    named = merged.withColumns({**columns, "updated_at": F.lit(updated_at)})
    return named.select(*schemas.BASELINE.fieldNames())


def write_states(states: DataFrame, path: str) -> None:
    """Replace the days that ``states`` has, and no others."""
    (
        states.hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def update_days(
    spark: SparkSession,
    events_path: str,
    states_path: str,
    since: date,
    until: date,
    window: str = params.DEFAULT_WINDOW,
    min_records: int = params.DEFAULT_MIN_RECORDS,
) -> None:
    """Bring the states of the days from ``since`` to ``until`` up to date with the event table.

    Only these days are read.
    """
    if 86_400_000 % params.duration_ms(window):
        raise ValueError(f"windows of {window} do not fit into a day")
    events = read_event_table(spark, events_path, since=since, until=until)
    windows = event_windows(clean_events(events), window, min_records)
    write_states(daily_states(windows), states_path)
