"""Logs of runs that Spark itself reports: a row per micro-batch with what was observed in it."""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tickloom import schemas
from tickloom.operators.metrics import throughput
from tickloom.sinks.tables import write_log

OBSERVED = "tickloom_latency"


def observe_latency(frame: DataFrame, latency_ms: Column) -> DataFrame:
    """``frame`` unchanged; Spark counts its rows and the range of their latency while they pass."""
    return frame.observe(
        OBSERVED,
        F.count(F.lit(1)).alias("records"),
        F.min(latency_ms).cast("double").alias("minimum_latency_ms"),
        F.max(latency_ms).cast("double").alias("maximum_latency_ms"),
    )


class RunLog(StreamingQueryListener):
    """Keeps a row for every micro-batch with input of the streams of a session, until it is written.

    Register it with ``spark.streams.addListener``. Reports come after the batch they are about, and a
    stream's last one before that of its end, which ``wait`` waits for.
    """

    def __init__(self) -> None:
        self._rows: list[tuple] = []
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if not progress.numInputRows:
            return
        seen = progress.observedMetrics.get(OBSERVED)
        found = (None, None, None) if seen is None else tuple(seen)
        with self._change:
            self._rows.append(
                (
                    str(progress.runId),
                    int(progress.batchId),
                    datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")),
                    int(progress.numInputRows),
                    progress.durationMs["triggerExecution"] / 1000,
                    *found,
                )
            )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def wait(self, run_id: str, seconds: float = 60.0) -> None:
        """Until the stream of this run has ended and all of its batches are reported."""
        with self._change:
            if not self._change.wait_for(lambda: run_id in self._ended, seconds):
                raise TimeoutError(f"no report of the end of {run_id}")

    def write(self, spark: SparkSession, path: str) -> None:
        with self._change:
            rows = list(self._rows)
        write_log(spark.createDataFrame(rows, schemas.BATCH_LOG), path)


def run_totals(log: DataFrame) -> DataFrame:
    """Per run: batches, records read and let through, seconds, rate and range of latency."""
    totals = log.groupBy("run_id").agg(
        F.count("*").alias("batches"),
        F.sum("input_records").alias("sent_records"),
        F.sum(F.col("input_records") - F.coalesce("records", "input_records")).alias("failed_records"),
        F.sum("runtime_seconds").alias("send_elapsed_seconds"),
        F.min("minimum_latency_ms").alias("minimum_latency_ms"),
        F.max("maximum_latency_ms").alias("maximum_latency_ms"),
    )
    rate = throughput(F.col("sent_records"), F.col("failed_records"), F.col("send_elapsed_seconds"))
    return totals.withColumns(rate)
