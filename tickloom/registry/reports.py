"""Run, latency and scaling summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import adapters
from tickloom.functions import events as fn
from tickloom.operators import metrics
from tickloom.operators.percentiles import exact_percentiles
from tickloom.registry import Query
from tickloom.registry.shared import SQL_EVENTS, events, rounded

NOW_MS = 1_785_000_000_000


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as runs: workers from the customer, state from the status, runtime from the total."""
    states = F.when(F.col("o_orderstatus") == "F", F.lit("COMPLETED")).otherwise(F.lit("FAILED"))
    return adapters.table(spark, folder, "orders").select(
        F.lit("orders").alias("data_source"),
        F.col("o_orderpriority").alias("environment"),
        F.col("o_orderkey").alias("repeat"),
        F.col("o_custkey").cast("string").alias("step_id"),
        (F.pmod("o_custkey", F.lit(6)) + 1).cast("int").alias("worker_count"),
        (F.col("o_custkey") * 1000 + 1).alias("input_records"),
        (F.col("o_totalprice") / 7.0).alias("runtime_seconds"),
        states.alias("state"),
    )


def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.run_summary(run_log(spark, folder))


def scaling_log(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a scaling log: one observation per order, one timeline per priority."""
    return adapters.table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("step_id"),
        (F.col("o_orderkey") * 20).cast("int").alias("elapsed_seconds"),
        (F.pmod("o_custkey", F.lit(5)) + 1).cast("int").alias("requested_workers"),
        (F.pmod("o_custkey", F.lit(4)) + 1).cast("int").alias("running_workers"),
        F.col("o_totalprice").alias("yarn_memory_available_pct"),
    )


def scaling_summary(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.scaling_summary(scaling_log(spark, folder), ("step_id",))


def scaling_summary_all(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.scaling_summary(scaling_log(spark, folder))


def latency_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Latency of the trades, one sample per symbol and minute from mid-January on."""
    rows = events(spark, folder).select(
        "symbol",
        fn.aligned_start("event_time", 60_000).alias("window_end"),
        (F.col("ingest_time") - F.col("event_time")).alias("latency_ms"),
    )
    return metrics.latency_summary(metrics.latency_samples(rows, 1_705_276_800_000))


def volume_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Exact volume quantiles per symbol over single trades."""
    return rounded(
        exact_percentiles(events(spark, folder), ["symbol"], "quote_volume", (0.0, 0.5, 0.95, 1.0))
    )


def price_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Exact quantiles over all sale prices at once."""
    lines = adapters.table(spark, folder, "lineitem").select("l_extendedprice")
    return rounded(exact_percentiles(lines, [], "l_extendedprice", (0.25, 0.5, 0.99)))


def throughput(spark: SparkSession, folder: str) -> DataFrame:
    """Records sent and failed per hour of the trades; errors count as failed."""
    hourly = (
        events(spark, folder)
        .groupBy(fn.aligned_start("event_time", 3_600_000).alias("hour"))
        .agg(
            F.count("*").alias("sent_records"),
            F.count_if(F.col("base_asset") == "ERROR").alias("failed_records"),
            ((F.max("event_time") - F.min("event_time")) / 1000.0).alias("send_elapsed_seconds"),
        )
    )
    columns = metrics.throughput(
        F.col("sent_records"), F.col("failed_records"), F.col("send_elapsed_seconds") / 700.0
    )
    return hourly.withColumns(columns).drop("send_elapsed_seconds")


QUERIES: dict[str, Query] = {
    "run_summary": run_summary,
    "scaling_summary": scaling_summary,
    "scaling_summary_all": scaling_summary_all,
    "latency_percentiles": latency_percentiles,
    "volume_percentiles": volume_percentiles,
    "price_percentiles": price_percentiles,
    "throughput": throughput,
}

_SCALING = """WITH g AS (
  SELECT o_orderpriority AS step_id, CAST(o_orderkey * 20 AS INTEGER) AS elapsed,
         CAST(o_custkey % 5 + 1 AS INTEGER) AS requested,
         CAST(o_custkey % 4 + 1 AS INTEGER) AS running, o_totalprice AS free
  FROM orders)"""
_SCALING_COLUMNS = """arg_min(running, elapsed) AS initial_workers,
  max(requested) AS peak_requested_workers, max(running) AS peak_running_workers,
  arg_max(running, elapsed) AS final_workers, min(free) AS minimum_yarn_available_pct,
  max(free) AS maximum_yarn_available_pct, max(elapsed) AS observation_seconds"""


def _quantiles_sql(table: str, value: str, quantiles: tuple[float, ...], key: str = "") -> str:
    """One row per group and quantile, with the number of values behind it."""
    select = f"{key}, " if key else ""
    group = f"GROUP BY {key}" if key else ""
    return " UNION ALL ".join(
        f"""SELECT {select}CAST({q} AS DOUBLE) AS quantile, count({value}) AS n,
  round(quantile_cont({value}, {q}), 6) AS value FROM {table} {group}"""
        for q in quantiles
    )


ORACLES: dict[str, str] = {
    "run_summary": """WITH r AS (
  SELECT o_orderpriority AS environment, o_orderkey AS repeat,
         CAST(o_custkey % 6 + 1 AS INTEGER) AS worker_count,
         o_custkey * 1000 + 1 AS input_records, o_totalprice / 7.0 AS runtime
  FROM orders WHERE o_orderstatus = 'F'),
g AS (
  SELECT worker_count, arg_min(environment, repeat) AS environment, count(*) AS repeats,
         arg_min(input_records, repeat) AS input_records, median(runtime) AS med,
         coalesce(stddev_samp(runtime), 0) AS sd, min(runtime) AS lo, max(runtime) AS hi
  FROM r GROUP BY worker_count),
one AS (SELECT med AS base FROM g WHERE worker_count = 1)
SELECT 'orders' AS data_source, environment, worker_count, repeats, input_records,
  round(med, 3) AS median_runtime_seconds, round(sd, 3) AS runtime_stdev_seconds,
  round(lo, 3) AS minimum_runtime_seconds, round(hi, 3) AS maximum_runtime_seconds,
  round(base / med, 4) AS speedup, round(base / med / worker_count, 4) AS parallel_efficiency,
  round(input_records / med, 2) AS records_per_second
FROM g, one""",
    "scaling_summary": f"{_SCALING} SELECT step_id, {_SCALING_COLUMNS} FROM g GROUP BY step_id",
    "scaling_summary_all": f"{_SCALING} SELECT {_SCALING_COLUMNS} FROM g",
    "latency_percentiles": f"""WITH {SQL_EVENTS},
l AS (SELECT CAST(min(ingest_time - event_time) AS DOUBLE) AS ms FROM m
      WHERE event_time - event_time % 60000 >= 1705276800000
      GROUP BY symbol, event_time - event_time % 60000)
SELECT count(*) AS latency_samples, round(quantile_cont(ms, 0.5), 3) AS p50_latency_ms,
  round(quantile_cont(ms, 0.95), 3) AS p95_latency_ms,
  round(quantile_cont(ms, 0.99), 3) AS p99_latency_ms,
  min(ms) AS minimum_latency_ms, max(ms) AS maximum_latency_ms
FROM l""",
    "volume_percentiles": f"""WITH {SQL_EVENTS}
{_quantiles_sql("m", "quote_volume", (0.0, 0.5, 0.95, 1.0), "symbol")}""",
    "price_percentiles": _quantiles_sql("lineitem", "l_extendedprice", (0.25, 0.5, 0.99)),
    "throughput": f"""WITH {SQL_EVENTS},
h AS (
  SELECT event_time - event_time % 3600000 AS hour, count(*) AS sent_records,
         count(*) FILTER (base_asset = 'ERROR') AS failed_records,
         (max(event_time) - min(event_time)) / 1000.0 / 700.0 AS seconds
  FROM m GROUP BY hour)
SELECT hour, sent_records, failed_records, sent_records - failed_records AS successful_records,
  round((sent_records - failed_records) / nullif(seconds, 0), 2) AS achieved_throughput
FROM h""",
}
