"""Removal of repeated trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import materialise

KEYS = ("symbol", "trade_id")
FILTER_LONGS = 1 << 20


def _bit(key: Column) -> Column:
    return F.call_function(
        "shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(key, 58).cast("int")
    )


def split_repeated(df: DataFrame, longs: int = FILTER_LONGS) -> tuple[DataFrame, DataFrame]:
    """Rows whose (symbol, trade id) certainly occurs once, or has no id, and all other rows.

    Hashes of the keys are counted first, eight bytes and a count a row. Those seen more than once go
    into a filter of 64 bits for each of ``longs`` (a power of two), which is sent out: a table of
    ``longs`` rows of 16 bytes at most. The fuller the filter, the more single rows are among the others.
    """
    key = F.xxhash64(*KEYS)
    repeated = (
        df.where(F.col("trade_id").isNotNull())
        .groupBy(key.alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    at = F.col("key").bitwiseAND(F.lit(longs - 1).cast("long"))
    bits = materialise(
        repeated.groupBy(at.alias("_at")).agg(F.bit_or(_bit(F.col("key"))).alias("_bits")), "repeated"
    )
    held = (
        df.withColumn("_key", F.when(F.col("trade_id").isNotNull(), key))
        .withColumn("_slot", F.col("_key").bitwiseAND(F.lit(longs - 1).cast("long")))
        .join(F.broadcast(bits), F.col("_slot") == F.col("_at"), "left")
        .withColumn(
            "_again", F.coalesce(F.col("_bits").bitwiseAND(_bit(F.col("_key"))) != 0, F.lit(False))
        )
    )
    return (
        held.where(~F.col("_again")).select(*df.columns),
        held.where(F.col("_again")).select(*df.columns),
    )


def dedupe_trades(df: DataFrame, longs: int = FILTER_LONGS) -> DataFrame:
    """One row per (symbol, trade id), the smallest by time then content; null ids all stay.

    Only rows whose key may be repeated are shuffled, after a partial aggregation, so a trade that a
    third of all rows repeat is one row per task. Runs a job that counts keys when it is called.
    """
    single, suspects = split_repeated(df, longs)
    rest = ["event_time", *[name for name in df.columns if name not in (*KEYS, "event_time")]]
    unique = (
        suspects.groupBy(*KEYS)
        .agg(F.min(F.struct(*rest)).alias("row"))
        .select(*KEYS, "row.*")
        .select(*df.columns)
    )
    return single.unionByName(unique)


def distinct_symbols(df: DataFrame) -> DataFrame:
    return df.select("symbol").distinct()
