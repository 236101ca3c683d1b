"""Columns that compare a recent window with the history of its symbol."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom import params


def return_pct(start: Column, end: Column) -> Column:
    """Percent change from ``start`` to ``end``; zero when there is no positive start."""
    # try_divide keeps the untaken branch from raising under ANSI mode.
    change = (F.try_divide(end, start) - 1.0) * 100.0
    return F.when(start > 0, change).otherwise(F.lit(0.0))


def zscore_or_zero(value: Column, mean: Column, stddev: Column) -> Column:
    return F.when(
        stddev > params.ZERO_STDDEV, F.try_divide(value - mean, stddev)
    ).otherwise(F.lit(0.0))


def zscore_or_null(value: Column, mean: Column, stddev: Column) -> Column:
    """z-score that is null where the history has no spread."""
    return F.try_divide(value - mean, F.nullif(stddev, F.lit(0.0)))


def weighted_trend(volume_z: Column, return_z: Column, activity_z: Column) -> Column:
    return (
        params.WEIGHT_VOLUME * volume_z
        + params.WEIGHT_RETURN * F.abs(return_z)
        + params.WEIGHT_ACTIVITY * activity_z
    )


def signed_trend(return_z: Column, volume_z: Column) -> Column:
    """Trend score of the history view: the two z-scores added, missing ones as zero."""
    return F.coalesce(return_z, F.lit(0.0)) + F.coalesce(volume_z, F.lit(0.0))


def spike_flag(
    return_z: Column,
    return_percent: Column,
    zscore: float = params.DEFAULT_SPIKE_ZSCORE,
    percent: float = params.DEFAULT_SPIKE_RETURN_PCT,
) -> Column:
    return (F.abs(return_z) >= zscore) & (F.abs(return_percent) >= percent)


def delay_ms(later: Column, earlier: Column) -> Column:
    """Milliseconds between two clocks, floored at zero."""
    return F.greatest(F.lit(0).cast("long"), later - earlier)
