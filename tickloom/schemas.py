"""Schemas of the tables the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType], required: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(name, kind, name not in required) for name, kind in fields])


_LONG, _DOUBLE, _STRING, _BOOL = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()

EVENT = _struct(
    ("schema_version", _LONG),
    ("event_type", _STRING),
    ("symbol", _STRING),
    ("base_asset", _STRING),
    ("event_time", _LONG),
    ("last_price", _DOUBLE),
    ("quote_volume", _DOUBLE),
    ("trade_count", _LONG),
    ("ingest_time", _LONG),
    ("trade_id", _LONG),
    required=("symbol", "event_time", "last_price", "quote_volume", "trade_count", "ingest_time"),
)
EVENT_COLUMNS = tuple(EVENT.fieldNames())

ARCHIVE_ROW = _struct(
    ("aggregate_id", _STRING),
    ("price", _STRING),
    ("quantity", _STRING),
    ("first_trade_id", _STRING),
    ("last_trade_id", _STRING),
    ("time", _STRING),
    ("buyer_maker", _STRING),
    ("best_match", _STRING),
)

WINDOW = _struct(
    ("symbol", _STRING),
    ("window_start", _LONG),
    ("window_end", _LONG),
    ("first_price", _DOUBLE),
    ("last_price", _DOUBLE),
    ("quote_volume_5m", _DOUBLE),
    ("trade_count_5m", _LONG),
    ("record_count", _LONG),
    ("first_event_time", _LONG),
    ("last_event_time", _LONG),
    ("last_ingest_time", _LONG),
    ("return_5m", _DOUBLE),
    ("latency_ms", _LONG),
)

BASELINE = _struct(
    ("symbol", _STRING),
    ("mean_return_5m", _DOUBLE),
    ("std_return_5m", _DOUBLE),
    ("mean_quote_volume_5m", _DOUBLE),
    ("std_quote_volume_5m", _DOUBLE),
    ("median_quote_volume_5m", _DOUBLE),
    ("sample_count", _LONG),
    ("updated_at", _STRING),
    ("mean_trade_count_5m", _DOUBLE),
    ("std_trade_count_5m", _DOUBLE),
)

BUCKET = _struct(
    ("bucket_start", _LONG),
    ("first_event_time", _LONG),
    ("last_event_time", _LONG),
    ("first_trade_id", _LONG),
    ("last_trade_id", _LONG),
    ("first_price", _DOUBLE),
    ("last_price", _DOUBLE),
    ("quote_volume", _DOUBLE),
    ("trade_count", _LONG),
)
SYMBOL_BUCKET = T.StructType([T.StructField("symbol", _STRING), *BUCKET.fields])
BUCKET_STATE = T.StructType(
    [
        T.StructField("symbol", _STRING),
        T.StructField("buckets", T.ArrayType(BUCKET)),
        T.StructField("checkpoints", T.MapType(_STRING, _STRING)),
        T.StructField("newest_event_time", _LONG),
    ]
)

SCORE = _struct(
    ("symbol", _STRING),
    ("base_asset", _STRING),
    ("price", _DOUBLE),
    ("return_5m_pct", _DOUBLE),
    ("quote_volume_5m", _DOUBLE),
    ("trade_count_5m", _LONG),
    ("trend_score", _DOUBLE),
    ("spike_zscore", _DOUBLE),
    ("is_spike", _BOOL),
    ("window_start", _LONG),
    ("window_end", _LONG),
    ("latency_ms", _LONG),
    ("result_type", _STRING),
    ("volume_zscore", _DOUBLE),
    ("trade_activity_zscore", _DOUBLE),
    ("batch_mean_return_5m", _DOUBLE),
    ("batch_mean_quote_volume_5m", _DOUBLE),
    ("baseline_sample_count", _LONG),
    ("baseline_updated_at", _STRING),
    ("view_type", _STRING),
)
SCORE_COLUMNS = tuple(SCORE.fieldNames())

RUN_LOG = _struct(
    ("data_source", _STRING),
    ("environment", _STRING),
    ("cluster_id", _STRING),
    ("step_id", _STRING),
    ("worker_count", T.IntegerType()),
    ("repeat", T.IntegerType()),
    ("input_records", _LONG),
    ("runtime_seconds", _DOUBLE),
    ("state", _STRING),
    ("started_at", T.TimestampType()),
    ("ended_at", T.TimestampType()),
)

SCALING_LOG = _struct(
    ("timestamp", T.TimestampType()),
    ("elapsed_seconds", T.IntegerType()),
    ("step_id", _STRING),
    ("step_state", _STRING),
    ("requested_workers", T.IntegerType()),
    ("running_workers", T.IntegerType()),
    ("policy_state", _STRING),
    ("yarn_memory_available_pct", _DOUBLE),
)

LOAD_LOG = _struct(
    ("data_source", _STRING),
    ("environment", _STRING),
    ("target_ingestion_rate", _LONG),
    ("sent_records", _LONG),
    ("successful_records", _LONG),
    ("failed_records", _LONG),
    ("send_elapsed_seconds", _DOUBLE),
    ("achieved_throughput", _DOUBLE),
    ("latency_samples", _LONG),
    ("p50_end_to_end_latency_ms", _DOUBLE),
    ("p95_end_to_end_latency_ms", _DOUBLE),
    ("p99_end_to_end_latency_ms", _DOUBLE),
    ("minimum_latency_ms", _DOUBLE),
    ("maximum_latency_ms", _DOUBLE),
    ("symbols", _LONG),
    ("started_at", _STRING),
    ("ended_at", _STRING),
)

BATCH_LOG = _struct(
    ("run_id", _STRING),
    ("batch_id", _LONG),
    ("started_at", T.TimestampType()),
    ("input_records", _LONG),
    ("runtime_seconds", _DOUBLE),
    ("records", _LONG),
    ("minimum_latency_ms", _DOUBLE),
    ("maximum_latency_ms", _DOUBLE),
)
