"""Baselines merged out of daily states against those of the whole history."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F
from samples import START, as_dicts, event, frame, random_rows

from tickloom import schemas
from tickloom.operators import daily
from tickloom.operators.baselines import baselines
from tickloom.operators.windows import event_windows
from tickloom.session import materialise
from tickloom.sinks import tables

DAY = 86_400_000


def history(spark, days=5):
    """Random trades of several days, and a symbol with a single window."""
    rows = []
    for i in range(days):
        for row in random_rows(i, n=150, span=DAY):
            rows.append((*row[:4], START + i * DAY + row[4], *row[5:8], START + i * DAY + row[8], None if row[9] is None else i * 1000 + row[9]))
    rows += [event("ONEUSDT", START + k, 5.0 + k, 3.0, 1, None, 90_000 + k) for k in range(2)]
    return frame(spark, rows)


def test_moments_equal_those_of_the_whole_history(spark):
    windows = materialise(event_windows(history(spark), "1 hour"), "windows")
    merged = {r["symbol"]: r for r in as_dicts(daily.merged_baselines(daily.daily_states(windows), "t"))}
    whole = {r["symbol"]: r for r in as_dicts(baselines(windows, "t"))}
    assert set(merged) == set(whole)
    for symbol, row in whole.items():
        for name, value in row.items():
            if name.startswith(("mean", "std")):
                assert merged[symbol][name] == pytest.approx(value, rel=1e-9, abs=1e-9)
        assert merged[symbol]["sample_count"] == row["sample_count"]
    assert merged["ONEUSDT"]["std_return_5m"] == 0.0


def test_median_has_the_stated_rank(spark):
    windows = spark.range(60_000).select(
        F.lit("A").alias("symbol"),
        (F.lit(START) + F.col("id") * 60_000).alias("window_start"),
        F.lit(1.0).alias("return_5m"),
        (F.xxhash64("id") % 1_000_003).cast("double").alias("quote_volume_5m"),
        F.lit(1).cast("long").alias("trade_count_5m"),
    )
    (row,) = daily.merged_baselines(daily.daily_states(windows), "t").collect()
    below = windows.where(F.col("quote_volume_5m") < row["median_quote_volume_5m"]).count() / 60_000
    assert abs(below - 0.5) <= daily.MEDIAN_RANK_ERROR


def test_a_new_day_reads_and_replaces_that_day_only(spark, tmp_path):
    events, states = str(tmp_path / "events"), str(tmp_path / "states")
    trades = history(spark)
    tables.write_event_table(trades.select(*schemas.EVENT_COLUMNS), events)
    first = datetime.date(2027, 1, 1)
    last = first + datetime.timedelta(4)
    daily.update_days(spark, events, states, first, last, "1 hour")
    old = {f"{p.parent.name}/{p.name}": p.stat().st_mtime_ns for p in (tmp_path / "states").glob("date=*/*.parquet")}
    # days that cannot be read prove that they are not
    for folder in (tmp_path / "events").glob("date=*"):
        if folder.name != f"date={last}":
            for part in folder.rglob("*.parquet"):
                part.write_bytes(b"broken")
    daily.update_days(spark, events, states, last, last, "1 hour")
    new = {f"{p.parent.name}/{p.name}": p.stat().st_mtime_ns for p in (tmp_path / "states").glob("date=*/*.parquet")}
    kept = {name for name in old if not name.startswith(f"date={last}/")}
    assert {name: new[name] for name in kept} == {name: old[name] for name in kept}
    assert len(new) == len(old) == len(kept) + 1 and set(new) != set(old)
    whole = baselines(materialise(event_windows(trades, "1 hour"), "w"), "t").select("symbol", "sample_count", F.round("mean_return_5m", 9))
    merged = daily.merged_baselines(spark.read.parquet(states), "t").select("symbol", "sample_count", F.round("mean_return_5m", 9))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))


def test_windows_must_fit_a_day(spark, tmp_path):
    with pytest.raises(ValueError):
        daily.update_days(spark, "x", "y", datetime.date(2027, 1, 1), datetime.date(2027, 1, 1), "7 hours")
