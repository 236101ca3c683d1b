"""Full-history statistics per symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import params, schemas
from tickloom.operators import percentiles
from tickloom.session import materialise

_MEASURES = ("return_5m", "quote_volume_5m", "trade_count_5m")


def history_columns(measures: tuple[str, ...] = _MEASURES) -> list[Column]:
    """Mean and sample standard deviation of each measure; null spread for one window."""
    columns = []
    for measure in measures:
        columns.append(F.avg(measure).alias(f"mean_{measure}"))
        columns.append(F.stddev_samp(measure).alias(f"std_{measure}"))
    return columns


def baselines(windows: DataFrame, updated_at: str, median: str = "exact") -> DataFrame:
    """One baseline row per symbol.

    ``windows`` is read twice for the exact median, so pass a written table. The first pass merges
    small partial states (moments and a quantile sketch), the second counts the values next to
    the median; no task ever sees all windows of a symbol. ``median="approx"`` stops after the
    first pass with the sketch's own answer, an actual window volume.
    """
    if median not in ("exact", "approx"):
        raise ValueError(f"unknown median: {median!r}")
    stats = [*history_columns(), F.count("*").alias("sample_count")]
    volume = "quote_volume_5m"
    if median == "approx":
        middle = F.percentile_approx(volume, 0.5, percentiles.ACCURACY)
        rows = windows.groupBy("symbol").agg(*stats, middle.alias(f"median_{volume}"))
    else:
        sketched = materialise(
            windows.groupBy("symbol").agg(
                *stats, *percentiles.bracket_columns(volume, (0.5,))
            ),
            "baseline-stats",
        )
        medians = percentiles.refine(windows, ["symbol"], volume, sketched)
        rows = sketched.join(
            medians.select("symbol", F.col("value").alias(f"median_{volume}")), "symbol", "left"
        )
    return (
        rows.fillna(0.0, subset=[f"std_{measure}" for measure in _MEASURES])
        .withColumn("updated_at", F.lit(updated_at))
        .select(*schemas.BASELINE.fieldNames())
    )


def tagged(baseline_rows: DataFrame) -> DataFrame:
    """Baselines with the two marker columns of the published table."""
    return baseline_rows.withColumns(
        {
            "view_type": F.lit("batch_baseline"),
            "schema_version": F.lit(params.SCHEMA_VERSION).cast("long"),
        }
    )
