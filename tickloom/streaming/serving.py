"""Serving outputs refreshed by the stream: the snapshot document and the keyed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tickloom import params, schemas
from tickloom.operators.serving import serving_rows
from tickloom.plans.hybrid import serving_views
from tickloom.sinks.tables import snapshot_document
from tickloom.streaming.hybrid import HybridView
from tickloom.streaming.tables import KeyedTable, Published

STORED_ROW = T.StructType(
    [
        *[f for f in schemas.SCORE.fields if f.name != "window_end"],
        T.StructField("window_end", T.StringType()),
        T.StructField("rank", T.LongType()),
        T.StructField("result_key", T.StringType()),
        T.StructField("expires_at", T.LongType()),
    ]
)


DOCUMENT = T.StructType([T.StructField("value", T.StringType())])


class ServingRefresh:
    """Micro-batch step: update the hybrid view, then publish its top lists.

    Both lists come from one read of the stored rows, so they agree with each other. The trigger
    of the stream is the refresh interval; a run that ends refreshes a last time by itself. The rows
    are those of two lists of ``top_n`` until they expire, so one part holds them.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        view: HybridView,
        top_n: int = params.DEFAULT_TOP_N,
        retention_seconds: int = params.DEFAULT_SERVING_RETENTION_SECONDS,
    ) -> None:
        self.view, self.top_n, self.retention_seconds = view, top_n, retention_seconds
        self.documents = Published(spark, f"{path}/document", DOCUMENT)
        self.rows = KeyedTable(spark, f"{path}/rows", STORED_ROW, "result_key", 1)

    def __call__(self, windows: DataFrame, batch_id: int) -> None:
        self.view(windows, batch_id)
        scores = self.view.served().select(*schemas.SCORE_COLUMNS)
        trending, spikes = serving_views(scores, self.top_n)
        # readers keep the last whole document until the next one is published
        self.documents.write(snapshot_document(trending, spikes), batch_id)
        now = self.view.clock_ms() // 1000
        self.rows.merge(serving_rows(trending, spikes, now + self.retention_seconds), batch_id, now)

    def document(self) -> DataFrame:
        """The newest published document, one row with its JSON text."""
        return self.documents.current()
