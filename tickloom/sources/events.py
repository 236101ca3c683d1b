"""Readers of canonical events stored as JSON Lines."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas
from tickloom.session import materialise

# Fixed value: names of event files, those with one of three suffixes or none at all.
EVENT_FILE_NAME = r"(?i)(^[^.]+$)|(\.(json|jsonl|gz)$)"


def read_events(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All events below ``path``; gzip is transparent, unreadable lines give all-null rows."""
    return (
        spark.read.schema(schemas.EVENT).option("recursiveFileLookup", "true").json(path)
    )


def read_events_strict(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Events of files with a known suffix; a malformed line fails the job.

    The name test is on a file metadata column, so other files are never opened.
    """
    return (
        spark.read.schema(schemas.EVENT)
        .option("recursiveFileLookup", "true")
        .option("mode", "FAILFAST")
        .json(path)
        .where(F.col("_metadata.file_name").rlike(EVENT_FILE_NAME))
    )


def _by_date(rows: DataFrame, since: date | None, until: date | None, symbols: list[str] | None):
    """Rows of partitions within the dates, both included, and of the symbols."""
    if since is not None:
        rows = rows.where(F.col("date") >= F.lit(since))
    if until is not None:
        rows = rows.where(F.col("date") <= F.lit(until))
    if symbols is not None:
        rows = rows.where(F.col("symbol").isin(symbols))
    return rows.select(*schemas.EVENT_COLUMNS)


def read_event_table(
    spark: SparkSession,
    path: str,
    since: date | None = None,
    until: date | None = None,
    symbols: list[str] | None = None,
) -> DataFrame:
    """Events of a Parquet table by date and symbol; other dates and symbols are not opened."""
    schema = T.StructType([*schemas.EVENT.fields, T.StructField("date", T.DateType())])
    return _by_date(spark.read.schema(schema).parquet(path), since, until, symbols)


def read_newest_days(spark: SparkSession, path: str, days_before: int = 1) -> DataFrame:
    """Events of the event table from each symbol's newest day and the ``days_before`` it.

    The newest days come from the files' paths alone, of which none is opened. The table is joined with
    them, so Spark prunes its folders when the query runs: a symbol that has been silent for a year
    opens its own last days, and of other symbols at most these same days, not the year between.
    """
    schema = T.StructType([*schemas.EVENT.fields, T.StructField("date", T.DateType())])
    table = spark.read.schema(schema).parquet(path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    newest = files.groupBy(F.col("symbol").cast("string").alias("symbol")).agg(
        F.max(F.col("date").cast("date")).alias("newest")
    )
    days = F.sequence(F.date_sub("newest", days_before), F.col("newest"))
    wanted = materialise(newest.select("symbol", F.explode(days).alias("date")), "newest-days")
    oldest = wanted.agg(F.min("date")).first()[0]
    # a filter on the small side is what lets Spark prune by it
    chosen = wanted.where(F.col("date") >= F.lit(oldest))
    return table.join(chosen, ["symbol", "date"], "left_semi").select(*schemas.EVENT_COLUMNS)


def read_archived_events(
    spark: SparkSession,
    path: str,
    since: date | None = None,
    until: date | None = None,
    symbols: list[str] | None = None,
) -> DataFrame:
    """Events of the raw archive by date, hour and symbol; pruned like the table."""
    fields = [T.StructField("date", T.DateType()), T.StructField("hour", T.StringType())]
    schema = T.StructType([*schemas.EVENT.fields, *fields])
    return _by_date(spark.read.schema(schema).json(path), since, until, symbols)


def read_event_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Events of files as they arrive below ``path``."""
    reader = spark.readStream.schema(schemas.EVENT).option("recursiveFileLookup", "true")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def read_line_stream(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines of files as they arrive below ``path``, for steps that set bad ones apart."""
    return spark.readStream.option("recursiveFileLookup", "true").text(path)


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parse JSON text; adds the event columns and ``_corrupt_record`` (null for good lines)."""
    schema = T.StructType([*schemas.EVENT.fields, T.StructField("_corrupt_record", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return lines.withColumn("_event", F.from_json(column, schema, options)).select(
        *[name for name in lines.columns], "_event.*"
    )


def split_malformed(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Good events and, apart from them, the raw text of lines that do not parse."""
    parsed = parse_lines(lines.where(F.trim(column) != ""), column)
    good = parsed.where(F.col("_corrupt_record").isNull()).select(*schemas.EVENT_COLUMNS)
    bad = parsed.where(F.col("_corrupt_record").isNotNull()).select(
        F.col("_corrupt_record").alias("raw")
    )
    return good, bad


def create_events_table(spark: SparkSession, path: str, name: str = "raw_market_events") -> None:
    """Catalog table over raw JSON; malformed rows are left out."""
    spark.catalog.createTable(
        name,
        path=path,
        source="json",
        schema=schemas.EVENT,
        mode="DROPMALFORMED",
        recursiveFileLookup="true",
    )


def create_windows_table(spark: SparkSession, path: str, name: str = "batch_windows") -> None:
    """Catalog table over windows written by symbol; a filter on symbol prunes folders."""
    fields = ", ".join(
        f"{field.name} {field.dataType.simpleString()}" for field in schemas.WINDOW.fields
    )
    spark.sql(
        f"CREATE TABLE {name} ({fields}) USING parquet PARTITIONED BY (symbol) LOCATION '{path}'"
    )
    spark.catalog.recoverPartitions(name)
