"""Ranks and top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import materialise


def rank_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number all rows of ``df`` 1, 2, … in ``order``, which must be total.

    The rows are range-partitioned by ``order`` and written once; each slice is numbered on its own
    and shifted by the size of the slices before it.
    """
    sliced = materialise(
        df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "ranked"
    )
    sizes = sliced.groupBy("_slice").agg(F.count("*").alias("size"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_slice", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("_offset")
    )
    within = F.row_number().over(Window.partitionBy("_slice").orderBy(*order))
    return (
        sliced.withColumn("_within", within)
        .join(offsets, "_slice")
        .withColumn(name, (F.col("_within") + F.col("_offset")).cast("long"))
        .drop("_slice", "_within", "_offset")
    )


def live_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The same numbers as a plan that runs nothing until it is read, for views over one row per
    symbol: a single task numbers them."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))


def top_rows(df: DataFrame, order: list[Column], n: int, name: str | None = None) -> DataFrame:
    """First ``n`` rows in ``order``, numbered if ``name`` is given."""
    top = df.orderBy(*order).limit(n)
    if name is None:
        return top
    return top.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))


def trend_order() -> list[Column]:
    return [F.desc("trend_score"), F.asc("symbol")]


def spike_order() -> list[Column]:
    return [F.abs("spike_zscore").desc(), F.asc("symbol")]


def top_trending(scores: DataFrame, n: int, name: str | None = None) -> DataFrame:
    return top_rows(scores, trend_order(), n, name)


def top_spikes(scores: DataFrame, n: int, name: str | None = None) -> DataFrame:
    return top_rows(scores.where("is_spike"), spike_order(), n, name)
