"""Exact percentiles that never hold a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import materialise

# The sketch answers with a rank error of at most 1/ACCURACY of the group; the bracket leaves twice
# that on either side. The rounding of ranks, up to two of them, fits between the two from SMALL_GROUP
# rows on; the few values of smaller groups are bracketed by their extremes.
ACCURACY = 10_000
MARGIN = 2.0 / ACCURACY
SMALL_GROUP = 2 * ACCURACY
# Brackets that may hold more values than CANDIDATES are narrowed, BINS times at once.
CANDIDATES = 1_000_000
BINS = 1024


def bracket_columns(value: str, quantiles: tuple[float, ...]) -> list[Column]:
    """Aggregates that bracket each quantile of ``value``: columns ``n`` and ``brackets``."""
    lows = [max(0.0, q - MARGIN) for q in quantiles]
    highs = [min(1.0, q + MARGIN) for q in quantiles]
    sketch = F.percentile_approx(value, lows + highs, ACCURACY)
    count, low, high = F.count(value), F.min(value), F.max(value)
    brackets = []
    for i, q in enumerate(quantiles):
        lower = low if lows[i] == 0.0 else F.when(count <= SMALL_GROUP, low).otherwise(sketch[i])
        upper = high
        if highs[i] < 1.0:
            upper = F.when(count <= SMALL_GROUP, high).otherwise(sketch[len(quantiles) + i])
        brackets.append(
            F.struct(
                F.lit(q).alias("quantile"), lower.alias("lower"), upper.alias("upper")
            )
        )
    return [count.alias("n"), F.array(*brackets).alias("brackets")]


def _narrowed(values: DataFrame, keys: list[str], ranges: DataFrame) -> DataFrame:
    """``ranges`` with brackets of at most ``CANDIDATES`` values, or of one bin that cannot be cut.

    A pass cuts each bracket into ``BINS`` of equal width and counts the values in each, a row per bin and
    task in the shuffle. The bins that hold the ranks asked for are the next bracket.
    """
    group = [*keys, "quantile"]
    position = (F.col("n") - 1) * F.col("quantile")
    last = float("inf")
    while True:
        ranges = materialise(ranges, "ranges")
        joined = values.join(ranges, keys) if keys else values.join(F.broadcast(ranges))
        width = F.col("upper") - F.col("lower")
        at = F.floor((F.col("value") - F.col("lower")) / width * BINS)
        bin_ = F.when(F.col("value") < F.col("lower"), -1).when(width > 0, F.least(at, F.lit(BINS - 1)))
        counts = (
            joined.where(F.col("value") <= F.col("upper"))
            .groupBy(*group, "n", F.coalesce(bin_, F.lit(0)).cast("int").alias("bin"))
            .agg(F.count("*").alias("held"), F.min("value").alias("low"), F.max("value").alias("high"))
        )
        upto = Window.partitionBy(*group).orderBy("bin").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        # at most BINS + 1 rows a group
        ends = counts.withColumn("upto", F.sum("held").over(upto))
        first, final = F.floor(position), F.ceil(position)
        wanted = (F.col("upto") > first) & (F.col("upto") - F.col("held") <= final) & (F.col("bin") >= 0)
        tight = materialise(
            ends.where(wanted)
            .groupBy(*group, "n")
            .agg(F.min("low").alias("lower"), F.max("high").alias("upper"), F.sum("held").alias("held")),
            "tight",
        )
        ranges = tight.select(*keys, "n", "quantile", "lower", "upper")
        most, widest = tight.agg(F.max("held"), F.sum(F.col("upper") - F.col("lower"))).first()
        # equal values are one candidate however many they are, and cannot be parted
        if most is None or most <= CANDIDATES or not widest < last:
            return ranges
        last = widest


def refine(df: DataFrame, keys: list[str], value: str, bracketed: DataFrame) -> DataFrame:
    """Exact quantiles, one row per key and quantile, from frames that share ``keys``.

    Rows above a bracket are dropped, rows below it are only counted, so what is left to rank per
    group is about ``4 / ACCURACY`` of it, collapsed to distinct values before the shuffle. Where that
    may still be more than ``CANDIDATES``, brackets are narrowed first by passes that only count.
    """
    ranges = bracketed.select(*keys, "n", F.explode("brackets").alias("bracket")).select(
        *keys, "n", "bracket.*"
    )
    values = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("value"))
    largest = bracketed.agg(F.max("n")).first()[0] or 0
    # the bracket's rank, with the error on both sides
    if largest * 3 * MARGIN > CANDIDATES:
        ranges = _narrowed(values, keys, ranges)
    # Without keys the other side is one row per quantile asked for, so broadcasting it is safe.
    joined = values.join(ranges, keys) if keys else values.join(F.broadcast(ranges))
    group = [*keys, "quantile"]
    counts = (
        joined.where(F.col("value") <= F.col("upper"))
        .withColumn("value", F.when(F.col("value") >= F.col("lower"), F.col("value")))
        .groupBy(*group, "n", "value")
        .agg(F.count("*").alias("copies"))
    )
    upto = Window.partitionBy(*group).orderBy(F.asc_nulls_first("value")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    position = (F.col("n") - 1) * F.col("quantile")
    covered = counts.withColumn("upto", F.sum("copies").over(upto))

    def at_rank(rank: Column) -> Column:
        return F.min(F.when((F.col("upto") > rank) & F.col("value").isNotNull(), F.col("value")))

    below = F.coalesce(F.max(F.when(F.col("value").isNull(), F.col("copies"))), F.lit(0))
    picked = covered.groupBy(*group, "n").agg(
        at_rank(F.floor(position)).alias("low_value"),
        at_rank(F.ceil(position)).alias("high_value"),
        below.alias("below"),
    )
    exact = F.col("low_value") + (F.col("high_value") - F.col("low_value")) * (
        position - F.floor(position)
    )
    # The sketch's error bound makes a miss impossible; should it ever happen, fail rather than lie.
    found = (F.col("below") <= F.floor(position)) & F.col("high_value").isNotNull()
    checked = F.when(found, exact).otherwise(
        F.raise_error(F.lit("percentile bracket missed its rank")).cast("double")
    )
    return picked.select(*group, F.col("n"), checked.alias("value"))


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, quantiles: tuple[float, ...]
) -> DataFrame:
    """Linear-interpolated quantiles: columns ``keys``, ``quantile``, ``n``, ``value``.

    Two passes over ``df``: one mergeable sketch per group, then a count of the few candidate
    values around each rank. The sketch table has one row per key and is written first, so that
    Catalyst broadcasts it by its real size or shuffles when it is large.
    """
    grouped = df.groupBy(*keys) if keys else df.groupBy()
    bracketed = materialise(grouped.agg(*bracket_columns(value, quantiles)), "brackets")
    return refine(df, keys, value, bracketed)
