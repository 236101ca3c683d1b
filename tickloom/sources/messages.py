"""Parsers for exchange messages and stream records held in columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import params, schemas
from tickloom.functions import events as fn

# Message kind that carries a trade, and its name in the event table.
TRADE_MESSAGE = "aggTrade"
_TEXT_MAP = "map<string,string>"


def parse_messages(
    df: DataFrame, ingest_time: Column | str | None = None, column: str = "value"
) -> DataFrame:
    """Trades out of raw exchange messages, bare or wrapped in ``data``.

    Other message kinds, other symbols and messages with a missing or unreadable field give no
    row. Maps, not structs, because ``e`` and ``E`` differ only in case.
    """
    arrival = F.unix_millis(F.current_timestamp()) if ingest_time is None else ingest_time
    if isinstance(arrival, str):
        arrival = F.col(arrival)
    # A filter is not pushed through explode, so each text is parsed once, not once per predicate.
    outer = df.select(
        arrival.cast("long").alias("_arrival"),
        F.explode(F.array(F.from_json(column, _TEXT_MAP))).alias("_outer"),
    )
    wrapped = F.from_json(F.col("_outer")["data"], _TEXT_MAP)
    payload = outer.select(
        "_arrival", F.explode(F.array(F.coalesce(wrapped, "_outer"))).alias("_payload")
    )

    def field(name: str) -> Column:
        return F.col("_payload")[name]

    clock = field("E")
    fields = payload.where(field("e") == TRADE_MESSAGE).select(
        F.upper(field("s")).alias("symbol"),
        F.coalesce(clock.try_cast("long"), clock.try_cast("double").try_cast("long")).alias("event_time"),
        field("p").try_cast("double").alias("last_price"),
        field("q").try_cast("double").alias("quantity"),
        field("a").try_cast("long").alias("trade_id"),
        F.col("_arrival").alias("ingest_time"),
    )
    readable = F.lit(True)
    for name in ("event_time", "last_price", "quantity", "trade_id"):
        readable = readable & F.col(name).isNotNull()
    return (
        fields.where(fn.is_spot_symbol("symbol") & readable)
        .withColumns(
            {
                "schema_version": F.lit(params.SCHEMA_VERSION).cast("long"),
                "event_type": F.lit(TRADE_MESSAGE),
                "base_asset": fn.base_asset("symbol"),
                "event_time": fn.epoch_millis("event_time"),
                "quote_volume": F.col("last_price") * F.col("quantity"),
                "trade_count": F.lit(1).cast("long"),
            }
        )
        .select(*schemas.EVENT_COLUMNS)
    )


def decode_records(
    df: DataFrame,
    data: str = "data",
    event_id: str = "event_id",
    sequence_number: str = "sequence_number",
) -> DataFrame:
    """Events out of base64 JSON records, with their shard and sequence.

    The shard is the part of the record id before the first colon; a missing sequence number is
    taken from the part after it.
    """
    identity = F.coalesce(F.col(event_id), F.lit("unknown:0"))
    colon = F.instr(identity, ":")
    after = F.when(colon > 0, F.substr(identity, colon + F.lit(1))).otherwise(F.lit(""))
    from_id = F.when(after == "", F.lit("0")).otherwise(after)
    text = F.decode(F.unbase64(F.col(data)), "UTF-8")
    return (
        df.withColumn("_event", F.from_json(text, schemas.EVENT))
        .select(
            "_event.*",
            F.substring_index(identity, ":", 1).alias("_shard_id"),
            F.coalesce(F.col(sequence_number), from_id).alias("_sequence"),
        )
        .withColumn("symbol", F.upper("symbol"))
    )


def decode_stream_rows(df: DataFrame) -> DataFrame:
    """Events out of connector rows (value, topic, partition, offset), with shard and sequence.

    The layout is that of the Kafka source, batch or stream; the value is one JSON event.
    """
    return df.select(
        F.from_json(F.col("value").cast("string"), schemas.EVENT).alias("_event"),
        F.concat_ws("-", "topic", F.col("partition").cast("string")).alias("_shard_id"),
        F.col("offset").cast("string").alias("_sequence"),
    ).select(
        "_event.*", "_shard_id", "_sequence"
    ).withColumn("symbol", F.upper("symbol"))


RECORD = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("data", "event_id", "sequence_number")]
)


def read_record_files(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of sharded records, base64 in JSON Lines, as files arrive below ``path``."""
    reader = spark.readStream.schema(RECORD).option("recursiveFileLookup", "true")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def read_record_stream(
    spark: SparkSession, source: str, options: dict[str, str], from_start: bool = False
) -> DataFrame:
    """Rows of a sharded stream through its connector, from the newest offset unless told else.

    Shard discovery, polling and resuming are the connector's and the checkpoint's work.
    """
    reader = spark.readStream.format(source).options(**options)
    if "startingOffsets" not in options:
        reader = reader.option("startingOffsets", "earliest" if from_start else "latest")
    return reader.load()


def keyed_records(df: DataFrame) -> DataFrame:
    """Key and value columns for a keyed stream: symbol, and one JSON line with its newline."""
    columns = [name for name in schemas.EVENT_COLUMNS if name in df.columns]
    return df.select(
        F.coalesce("symbol", F.lit("UNKNOWN")).alias("key"),
        F.concat(fn.canonical_json(columns), F.lit("\n")).alias("value"),
    )
