"""Historical trade archives and the list of days to fetch."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import params, schemas
from tickloom.functions import events as fn
from tickloom.session import path_exists
from tickloom.sinks.tables import write_events_by_day

# Layout of archive paths and the tag of their events.
FILE_SYMBOL = r"/(?:symbol=)?([^/=]+)/[^/]+$"
FILE_DAY = r"([0-9]{4}-[0-9]{2}-[0-9]{2})[^/]*$"
FOLDER_DAY = r"/day=([0-9]{4}-[0-9]{2}-[0-9]{2})/"
OUTPUT_FOLDER = r"/symbol=([^/]+)/date=([0-9]{4}-[0-9]{2}-[0-9]{2})/[^/]+$"
ARCHIVE_SOURCE = "binance-vision-historical"


def read_archive(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows of headerless archive files, with the symbol that their folder is named after."""
    return (
        spark.read.schema(schemas.ARCHIVE_ROW)
        .option("recursiveFileLookup", "true")
        .csv(path)
        .withColumn("symbol", F.regexp_extract(F.col("_metadata.file_path"), FILE_SYMBOL, 1))
    )


def normalise_archive(df: DataFrame, symbol: Column | str = "symbol") -> DataFrame:
    """Canonical events out of archive rows; rows that do not start with a number are headings."""
    name = F.col(symbol) if isinstance(symbol, str) else symbol
    typed = df.where(F.col("aggregate_id").rlike("^[0-9]+$")).select(
        F.upper(name).alias("symbol"),
        F.col("aggregate_id").cast("long").alias("trade_id"),
        F.col("price").cast("double").alias("last_price"),
        F.col("quantity").cast("double").alias("quantity"),
        F.col("first_trade_id").cast("long").alias("first_id"),
        F.col("last_trade_id").cast("long").alias("last_id"),
        fn.epoch_millis(F.col("time").cast("long")).alias("event_time"),
    )
    return typed.withColumns(
        {
            "schema_version": F.lit(params.SCHEMA_VERSION).cast("long"),
            "event_type": F.lit("aggTrade"),
            "base_asset": fn.base_asset("symbol"),
            "quote_volume": F.col("last_price") * F.col("quantity"),
            "trade_count": fn.aggregate_trade_count("first_id", "last_id"),
            "ingest_time": F.col("event_time"),
            "source": F.lit(ARCHIVE_SOURCE),
        }
    ).select(*schemas.EVENT_COLUMNS, "source")


def backfill_manifest(
    symbols: DataFrame,
    start: date,
    end: date,
    existing: DataFrame | None = None,
    overwrite: bool = False,
) -> DataFrame:
    """Every (symbol, day) of an inclusive range that has no output yet.

    ``existing`` has the columns symbol and day; ``overwrite`` ignores it.
    """
    if end < start:
        raise ValueError("end must not be before start")
    days = F.sequence(F.lit(start), F.lit(end))
    wanted = symbols.select("symbol", F.explode(days).alias("day"))
    if existing is None or overwrite:
        return wanted
    return wanted.join(existing.select("symbol", "day"), ["symbol", "day"], "left_anti")


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Paths of the files below ``path``; contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    )


def existing_outputs(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, day) of the backfill folders already below ``path``, none if there is no such folder."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "symbol string, day date")
    return (
        _files(spark, path)
        .where(F.col("path").rlike(OUTPUT_FOLDER))
        .select(
            F.regexp_extract("path", OUTPUT_FOLDER, 1).alias("symbol"),
            F.to_date(F.regexp_extract("path", OUTPUT_FOLDER, 2)).alias("day"),
        )
        .distinct()
    )


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, symbol, day) of archive files.

    The day is told by a folder ``day=`` or else by the file's name, and null where neither does.
    """
    told = [F.nullif(F.regexp_extract("path", shape, 1), F.lit("")) for shape in (FOLDER_DAY, FILE_DAY)]
    return _files(spark, path).select(
        "path",
        F.upper(F.regexp_extract("path", FILE_SYMBOL, 1)).alias("symbol"),
        F.to_date(F.coalesce(*told)).alias("day"),
    )


def backfill(spark: SparkSession, archive: str, output: str, manifest: DataFrame) -> int:
    """Events of the manifest's days from archive to ``output``; the number of files read.

    Files are chosen by symbol and day before any is read. Folders of days that are written anew are
    replaced, all others stay as they are.
    """
    listed = archive_files(spark, archive).alias("f")
    wanted = (F.col("f.symbol") == F.col("m.symbol")) & (
        F.col("f.day").isNull() | (F.col("f.day") == F.col("m.day"))
    )
    chosen = [r["path"] for r in listed.join(manifest.alias("m"), wanted, "left_semi").collect()]
    if chosen:
        trades = normalise_archive(read_archive(spark, chosen))
        day = F.to_date(F.timestamp_millis("event_time"))
        days = trades.withColumn("day", day).join(manifest, ["symbol", "day"], "left_semi")
        write_events_by_day(days.drop("day"), output)
    return len(chosen)


def available_days(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Manifest entries that the archive really has; a missing day is skipped."""
    return manifest.join(listing.select("symbol", "day"), ["symbol", "day"], "left_semi")
