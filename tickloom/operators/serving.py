"""Ranked serving lists out of stored score rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import params
from tickloom.operators.ranking import rank_rows, spike_order, trend_order
from tickloom.session import materialise

# Fixed value: rank of a stored row that has none.
MISSING_RANK = 9999


def _window_end(df: DataFrame) -> Column:
    return F.coalesce(F.col("window_end").cast("long"), F.lit(0).cast("long"))


def newest_window_end(items: DataFrame) -> DataFrame:
    return items.agg(F.max(_window_end(items)).alias("latest_window"))


def fresh_rows(items: DataFrame, freshness_ms: int = params.DEFAULT_FRESHNESS_MS) -> DataFrame:
    """Rows whose window ended at most ``freshness_ms`` before the newest one."""
    newest = newest_window_end(items).scalar()
    return items.where(_window_end(items) >= newest - freshness_ms)


def newest_per_symbol(items: DataFrame) -> DataFrame:
    rest = [name for name in items.columns if name not in ("symbol", "window_end")]
    latest = items.groupBy("symbol").agg(
        F.max(F.struct(_window_end(items).alias("_end"), "window_end", *rest)).alias("row")
    )
    return latest.select("symbol", "row.*").select(*items.columns)


def hybrid_lists(
    items: DataFrame, freshness_ms: int = params.DEFAULT_FRESHNESS_MS
) -> tuple[DataFrame, DataFrame]:
    """Trending and spike lists from one hybrid row per symbol.

    A spike keeps its place in the trending list as ``rank`` next to its ``spike_rank``.
    """
    hybrid = fresh_rows(items, freshness_ms).where(F.col("view_type") == "hybrid")
    unique = materialise(
        newest_per_symbol(hybrid)
        .withColumn("trend_score", F.coalesce("trend_score", F.lit(0.0)))
        .withColumn("spike_zscore", F.coalesce("spike_zscore", F.lit(0.0)))
        .withColumn("result_type", F.lit("trend")),
        "serving",
    )
    trending = rank_rows(unique, trend_order(), "rank")
    spikes = rank_rows(
        materialise(trending.where("is_spike"), "spikes"), spike_order(), "spike_rank"
    )
    return trending, spikes


def ranked_lists(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lists from rows that were ranked when stored: the newest window only, by stored rank."""
    latest = fresh_rows(items, 0)
    order = [F.coalesce(F.col("rank").cast("long"), F.lit(MISSING_RANK)), F.col("symbol")]
    return tuple(
        latest.where(F.col("result_type") == kind).orderBy(*order) for kind in ("trend", "spike")
    )


def serving_lists(
    items: DataFrame, freshness_ms: int = params.DEFAULT_FRESHNESS_MS
) -> tuple[DataFrame, DataFrame]:
    """Both lists, from hybrid rows if a fresh one is stored, else from ranked rows."""
    if "view_type" in items.columns:
        hybrid = fresh_rows(items, freshness_ms).where(F.col("view_type") == "hybrid")
        if "result_key" in items.columns:
            hybrid = hybrid.where(F.col("result_key").isNull())
        if not hybrid.isEmpty():
            return hybrid_lists(items, freshness_ms)
    return ranked_lists(items)


def snapshot(items: DataFrame, freshness_ms: int = params.DEFAULT_FRESHNESS_MS) -> DataFrame:
    """Both lists in one frame with the newest window of the store, which a reader is told as well."""
    trending, spikes = hybrid_lists(items, freshness_ms)
    shown = ("symbol", "trend_score", "window_end")
    lists = trending.select(
        F.lit("trend").alias("list"), F.col("rank").alias("place"), *shown
    ).unionByName(spikes.select(F.lit("spike").alias("list"), F.col("spike_rank").alias("place"), *shown))
    newest = newest_window_end(items).scalar()
    return lists.withColumn("latest_window", newest)


def latest_stored(rows: DataFrame) -> DataFrame:
    """Rows of the newest window among the trend rows: its trends, then its spikes.

    Stored window ends are text and compared as text, as the key-value table sorts them.
    """
    newest = rows.where(F.col("result_type") == "trend").agg(F.max("window_end")).scalar()
    return rows.where((F.col("window_end") == newest) & F.col("result_type").isin("trend", "spike"))


def serving_rows(
    trending: DataFrame,
    spikes: DataFrame,
    expires_at: int,
    rank: str = "rank",
    spike_rank: str = "spike_rank",
) -> DataFrame:
    """Stored form of both lists: one row per list and symbol, keyed and with an expiry."""

    def stored(rows: DataFrame, kind: str, place: str) -> DataFrame:
        columns = [name for name in rows.columns if name not in ("rank", "spike_rank")]
        return rows.select(*columns, F.col(place).alias("rank")).withColumns(
            {
                "result_type": F.lit(kind),
                "result_key": F.concat(F.lit(f"{kind}#"), F.col("symbol")),
                "window_end": F.col("window_end").cast("string"),
                "expires_at": F.lit(expires_at).cast("long"),
            }
        )

    return stored(trending, "trend", rank).unionByName(stored(spikes, "spike", spike_rank))


def unexpired(rows: DataFrame, now_seconds: int) -> DataFrame:
    return rows.where(F.col("expires_at") > now_seconds)
