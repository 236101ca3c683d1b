"""Replay protection by shard and sequence number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _is_number(text: Column) -> Column:
    return text.rlike("^[0-9]+$")


def _magnitude(text: Column) -> Column:
    """Key that sorts digit strings of any length as numbers."""
    digits = F.regexp_replace(text, "^0+(?=[0-9])", "")
    return F.struct(F.length(digits).alias("digits"), digits.alias("text"))


def sequence_after(sequence: Column, previous: Column) -> Column:
    """True if ``sequence`` is new: numerically larger, or as text unless both are numbers."""
    numeric = _is_number(sequence) & _is_number(previous)
    return previous.isNull() | F.when(
        numeric, _magnitude(sequence) > _magnitude(previous)
    ).otherwise(sequence > previous)


def sequence_order(sequence: Column) -> Column:
    """Sort key over sequences: numbers by size, then everything else as text."""
    number = _is_number(sequence)
    return F.struct(
        (~number).alias("is_text"),
        F.when(number, _magnitude(sequence)).alias("magnitude"),
        sequence.alias("text"),
    )


def new_records(batch: DataFrame, checkpoints: DataFrame | None = None) -> DataFrame:
    """Records not seen before: once per (symbol, shard, sequence), beyond the checkpoint.

    ``checkpoints`` (symbol, shard, sequence) is the state before this batch, so the order of
    event times inside the batch cannot hide a record.
    """
    keys = ["symbol", "_shard_id", "_sequence"]
    rest = [name for name in batch.columns if name not in keys]
    once = (
        batch.groupBy(*keys)
        .agg(F.min(F.struct(*rest)).alias("row"))
        .select(*keys, "row.*")
        .select(*batch.columns)
    )
    if checkpoints is None:
        return once
    seen = checkpoints.select(
        "symbol", F.col("shard").alias("_shard_id"), F.col("sequence").alias("_previous")
    )
    return (
        once.join(seen, ["symbol", "_shard_id"], "left")
        .where(sequence_after(F.col("_sequence"), F.col("_previous")))
        .select(*batch.columns)
    )


def advance_checkpoints(records: DataFrame, checkpoints: DataFrame | None = None) -> DataFrame:
    """Largest sequence per (symbol, shard) after the given records."""
    reached = records.select(
        "symbol", F.col("_shard_id").alias("shard"), F.col("_sequence").alias("sequence")
    )
    if checkpoints is not None:
        reached = reached.unionByName(checkpoints.select("symbol", "shard", "sequence"))
    return reached.groupBy("symbol", "shard").agg(
        F.max_by("sequence", sequence_order(F.col("sequence"))).alias("sequence")
    )
