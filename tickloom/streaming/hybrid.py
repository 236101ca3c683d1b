"""The hybrid view of a stream: recent windows scored against baselines that may change."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom import params, schemas
from tickloom.operators.score import score_windows
from tickloom.session import RECOMMENDED_CONF, delete_path, scratch_path
from tickloom.streaming.tables import KeyedTable

_EXPIRY = T.StructField("expires_at", T.LongType())
STORED_SCORE = T.StructType([*schemas.SCORE.fields, _EXPIRY])
_STORE = "spark.sql.streaming.stateStore.providerClass"
_CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
_IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def _now_ms() -> int:
    return int(time.time() * 1000)


class Refreshing:
    """Rows that are loaded now and then, kept as a written table of their own in between.

    What was loaded stays readable when its source is overwritten. ``stamp`` tells versions of the
    source apart, None while it is being written: rows read while it changed do not count. The rows kept
    then stay, as they do when loading fails, and the next call tries again. The copy before the last
    one is deleted.
    """

    def __init__(
        self,
        load: Callable[[], DataFrame],
        seconds: float = params.DEFAULT_BASELINE_REFRESH_SECONDS,
        clock: Callable[[], float] = time.monotonic,
        stamp: Callable[[], object] = lambda: 0,
    ) -> None:
        self._load, self._seconds, self._clock, self._stamp = load, seconds, clock, stamp
        self._frame: DataFrame | None = None
        self._loaded_at = 0.0
        self._copies: list[str] = []

    def _loaded(self) -> DataFrame | None:
        before = self._stamp()
        if before is None:
            return None
        rows = self._load()
        spark = rows.sparkSession
        self._copies.append(scratch_path(spark, "refreshed"))
        rows.write.parquet(self._copies[-1])
        if self._stamp() != before:
            delete_path(spark, self._copies.pop())
            return None
        while len(self._copies) > 2:
            delete_path(spark, self._copies.pop(0))
        return spark.read.schema(rows.schema).parquet(self._copies[-1])

    def get(self) -> DataFrame:
        if self._frame is not None and self._clock() - self._loaded_at < self._seconds:
            return self._frame
        try:
            loaded = self._loaded()
        except Exception:
            if self._frame is None:
                raise
            loaded = None
        if loaded is not None:
            self._frame, self._loaded_at = loaded, self._clock()
        if self._frame is None:
            raise RuntimeError("the source is being written")
        return self._frame


class HybridView:
    """Micro-batch step on recent windows: score them and store the latest row of each symbol.

    Symbols without a baseline are scored once they have one. Only symbols of the batch are scored
    again, and only the parts of the table they fall into are written; the others keep their row.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        baselines: Refreshing,
        settings: params.Params = params.Params(),
        clock_ms: Callable[[], int] = _now_ms,
    ) -> None:
        self.baselines, self.settings, self.clock_ms = baselines, settings, clock_ms
        self.latest = KeyedTable(spark, f"{path}/latest", STORED_SCORE)

    def __call__(self, windows: DataFrame, batch_id: int) -> None:
        now = self.clock_ms()
        scores = score_windows(
            windows.where(F.col("records") >= self.settings.min_records),
            self.baselines.get(),
            now,
            self.settings.min_liquidity,
            self.settings.spike_zscore,
            self.settings.spike_return_pct,
        ).withColumn(
            "expires_at",
            F.lit(now // 1000 + self.settings.state_retention_seconds).cast("long"),
        )
        self.latest.merge(scores, batch_id, now // 1000)

    def served(self) -> DataFrame:
        """The stored rows that have not expired."""
        return self.latest.current(self.clock_ms() // 1000)


def start(
    frame: DataFrame,
    step: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Run ``step`` per micro-batch: every ``every``, or over what is there and then stop.

    Keyed state needs the RocksDB store, which writes what a batch changed and not its files. State that expires makes Spark run micro-batches without input
    for ever, so a run that is to stop goes without them. A query keeps the settings it starts with.
    """
    wanted = {name: RECOMMENDED_CONF[name] for name in (_STORE, _CHANGELOG)}
    if every is None:
        wanted[_IDLE_BATCHES] = "false"
    conf = frame.sparkSession.conf
    given = {name: conf.get(name, None) for name in wanted}
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    try:
        for name, value in wanted.items():
            conf.set(name, value)
        return (
            frame.writeStream.foreachBatch(step)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )
    finally:
        for name, value in given.items():
            if value is None:
                conf.unset(name)
            else:
                conf.set(name, value)
