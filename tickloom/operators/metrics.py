"""Summaries of run, latency and scaling logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.percentiles import exact_percentiles
from tickloom.session import materialise


def completed_runs(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("state") == "COMPLETED")


def run_summary(runs: DataFrame) -> DataFrame:
    """Runtime statistics per worker count and the speedup over one worker.

    Fails when no completed one-worker run exists, since nothing can be compared then.
    """
    done = completed_runs(runs)
    first_run = F.struct("repeat", "step_id")
    medians = exact_percentiles(done, ["worker_count"], "runtime_seconds", (0.5,))
    groups = materialise(
        done.groupBy("worker_count")
        .agg(
            F.min_by("data_source", first_run).alias("data_source"),
            F.min_by("environment", first_run).alias("environment"),
            F.count("*").alias("repeats"),
            F.min_by("input_records", first_run).alias("input_records"),
            F.coalesce(F.stddev_samp("runtime_seconds"), F.lit(0.0)).alias("stdev"),
            F.min("runtime_seconds").alias("fastest"),
            F.max("runtime_seconds").alias("slowest"),
        )
        .join(medians.select("worker_count", F.col("value").alias("median")), "worker_count"),
        "runs",
    )
    alone = groups.where(F.col("worker_count") == 1).select("median").scalar()
    baseline = F.coalesce(
        alone, F.raise_error(F.lit("no completed one-worker run")).cast("double")
    )
    speedup = baseline / F.col("median")
    return groups.select(
        "data_source",
        "environment",
        "worker_count",
        "repeats",
        "input_records",
        F.round("median", 3).alias("median_runtime_seconds"),
        F.round("stdev", 3).alias("runtime_stdev_seconds"),
        F.round("fastest", 3).alias("minimum_runtime_seconds"),
        F.round("slowest", 3).alias("maximum_runtime_seconds"),
        F.round(speedup, 4).alias("speedup"),
        F.round(speedup / F.col("worker_count"), 4).alias("parallel_efficiency"),
        F.round(F.col("input_records") / F.col("median"), 2).alias("records_per_second"),
    ).orderBy("worker_count")


def latency_samples(rows: DataFrame, since: Column | int) -> DataFrame:
    """One latency per distinct (symbol, window end) at or after ``since``."""
    start = F.lit(since).cast("long") if isinstance(since, int) else since
    return (
        rows.where(F.col("window_end") >= start)
        .groupBy("symbol", "window_end")
        .agg(F.min("latency_ms").cast("double").alias("latency_ms"))
    )


def latency_summary(samples: DataFrame) -> DataFrame:
    """Count, p50, p95, p99 and extremes of the latency, zero where there is no sample."""
    written = materialise(samples.select("latency_ms"), "samples")
    quantiles = exact_percentiles(written, [], "latency_ms", (0.5, 0.95, 0.99))

    def at(q: float, name: str) -> Column:
        chosen = F.max(F.when(F.col("quantile") == q, F.col("value")))
        return F.round(F.coalesce(chosen, F.lit(0.0)), 3).alias(name)

    # One row each: a global aggregate next to another.
    points = quantiles.agg(
        at(0.5, "p50_latency_ms"), at(0.95, "p95_latency_ms"), at(0.99, "p99_latency_ms")
    )
    extremes = written.agg(
        F.count("*").alias("latency_samples"),
        F.round(F.coalesce(F.min("latency_ms"), F.lit(0.0)), 3).alias("minimum_latency_ms"),
        F.round(F.coalesce(F.max("latency_ms"), F.lit(0.0)), 3).alias("maximum_latency_ms"),
    )
    return extremes.join(F.broadcast(points))


def throughput(sent: Column, failed: Column, elapsed_seconds: Column) -> dict[str, Column]:
    """Success count and rate of a run."""
    return {
        "successful_records": sent - failed,
        "achieved_throughput": F.round(F.try_divide(sent - failed, elapsed_seconds), 2),
    }


def scaling_summary(log: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """First, last and peak workers, memory range and length of a scaling log."""
    return log.groupBy(*keys).agg(
        F.min_by("running_workers", "elapsed_seconds").alias("initial_workers"),
        F.max("requested_workers").alias("peak_requested_workers"),
        F.max("running_workers").alias("peak_running_workers"),
        F.max_by("running_workers", "elapsed_seconds").alias("final_workers"),
        F.min("yarn_memory_available_pct").alias("minimum_yarn_available_pct"),
        F.max("yarn_memory_available_pct").alias("maximum_yarn_available_pct"),
        F.max("elapsed_seconds").alias("observation_seconds"),
    )


def event_counts(events: DataFrame) -> DataFrame:
    """Number of events and of distinct symbols."""
    return events.groupBy("symbol").agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("event_count"),
        F.count("symbol").alias("symbol_count"),
    )
