"""Sliding windows, buckets, scoring, serving."""

from __future__ import annotations

import itertools
import json
import math
import random

import pytest
from samples import as_dicts, baseline, event, frame, random_rows

from tickloom import params, schemas
from tickloom.operators import buckets as bk
from tickloom.operators import serving
from tickloom.operators.score import score_windows
from tickloom.operators.sliding import latest_sliding, sliding_windows
from tickloom.plans import hybrid
from tickloom.sinks.tables import snapshot_document

RECENT = "symbol string, start_price double, end_price double, quote_volume_5m double, trade_count_5m long, window_start long, window_end long"


def scored(spark, baselines, *, end=208.0, volume=26_000.0, trades=96, start=200.0, **settings):
    recent = spark.createDataFrame([("abcusdt", start, end, volume, trades, 4000, 7000)], RECENT)
    return as_dicts(score_windows(recent, baselines, 7800, **settings))


def test_score_of_a_spike(spark):
    (row,) = scored(spark, baseline(spark))
    assert list(row) == list(schemas.SCORE_COLUMNS)
    assert row["return_5m_pct"] == pytest.approx(4.0)
    assert row["is_spike"] and row["result_type"] == "spike"
    assert row["latency_ms"] == 800
    assert row["trend_score"] == pytest.approx(0.45 * 4.5 + 0.35 * 3.5 + 0.20 * 3)
    assert (row["baseline_sample_count"], row["view_type"]) == (40, "hybrid")
    assert (row["symbol"], row["base_asset"], row["price"]) == ("ABCUSDT", "ABC", 208.0)


def test_illiquid_rows_are_dropped(spark):
    assert scored(spark, baseline(spark, median_quote_volume_5m=100.0)) == []
    assert scored(spark, baseline(spark), volume=9_999.0) == []
    assert len(scored(spark, baseline(spark), volume=10_000.0)) == 1
    assert scored(spark, baseline(spark, symbol="XYZUSDT")) == []


def test_spike_needs_both_thresholds(spark):
    (small,) = scored(spark, baseline(spark, std_return_5m=0.1), end=203.0)
    assert small["spike_zscore"] == pytest.approx(10.0) and not small["is_spike"]
    (usual,) = scored(spark, baseline(spark, std_return_5m=2.0), end=206.0)
    assert not usual["is_spike"] and usual["result_type"] == "trend"


def test_zero_spread_and_zero_price(spark):
    (row,) = scored(spark, baseline(spark, std_return_5m=1e-12, std_quote_volume_5m=0.0), start=0.0)
    assert (row["return_5m_pct"], row["spike_zscore"], row["volume_zscore"]) == (0.0, 0.0, 0.0)


def test_window_is_closed_at_both_ends_and_ids_count_once(spark):
    first = event("ABCUSDT", 7_000, 50.0, 12_500.0, 40, None, 1)
    second = event("ABCUSDT", 307_000, 53.0, 17_500.0, 60, 307_900, 2)
    stats = baseline(
        spark, std_return_5m=0.5, std_quote_volume_5m=1_000.0, std_trade_count_5m=10.0
    )
    scores = hybrid.hybrid_from_events(
        frame(spark, [first, first, second]), stats, 308_000, dedupe=True
    )
    trending, spikes = hybrid.serving_views(scores, 1)
    (row,) = as_dicts(trending)
    assert (row["quote_volume_5m"], row["trade_count_5m"], row["rank"]) == (30_000.0, 100, 1)
    assert [r["is_spike"] for r in as_dicts(spikes)] == [True]
    late = event("ABCUSDT", 307_001, 53.0, 17_500.0, 60, None, 3)
    assert latest_sliding(frame(spark, [first, late])).count() == 0


def brute_sliding(rows, length):
    expected = []
    for r in rows:
        members = sorted(
            (m for m in rows if m[2] == r[2] and r[4] - length <= m[4] <= r[4]),
            key=lambda m: (m[4], -1 if m[9] is None else m[9], m[5]),
        )
        expected.append(
            (r[2], r[4], r[9], members[0][5], members[-1][5], sum(m[6] for m in members),
             sum(m[7] for m in members), len(members), members[0][4], r[4])
        )
    return sorted(expected, key=str)


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_sliding_windows_match_brute_force(spark, seed):
    rows = random_rows(seed, n=150)
    found = sliding_windows(frame(spark, rows), "5 seconds")
    names = found.columns
    assert names == [
        "symbol", "event_time", "trade_id", "start_price", "end_price", "quote_volume_5m",
        "trade_count_5m", "record_count", "window_start", "window_end",
    ]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_sliding(rows, 5_000)


def test_sliding_volumes_keep_their_digits(spark):
    """Volumes over twelve orders of magnitude: a large one that leaves takes no digits along."""
    rng = random.Random(6)
    rows = [
        event("A", i * 700, 1.0 + i, rng.uniform(1, 10) * 10.0 ** rng.randrange(-2, 11), 1, None, i)
        for i in range(400)
    ]
    volumes = {r[4]: [m[6] for m in rows if r[4] - 5_000 <= m[4] <= r[4]] for r in rows}
    for r in sliding_windows(frame(spark, rows), "5 seconds").collect():
        exact = math.fsum(volumes[r["event_time"]])
        assert r["quote_volume_5m"] == pytest.approx(exact, rel=1e-14)


@pytest.mark.parametrize("seed", [1, 2])
def test_latest_sliding_matches_brute_force(spark, seed):
    rows = random_rows(seed)
    found = {
        r["symbol"]: (r["start_price"], r["end_price"], r["quote_volume_5m"], r["record_count"])
        for r in as_dicts(latest_sliding(frame(spark, rows), "5 seconds", 1))
    }
    expected = {}
    for symbol in {r[2] for r in rows}:
        newest = max(r[4] for r in rows if r[2] == symbol)
        inside = sorted(
            (r for r in rows if r[2] == symbol and r[4] >= newest - 5_000),
            key=lambda r: (r[4], -1 if r[9] is None else r[9]),
        )
        expected[symbol] = (sum(r[6] for r in inside), len(inside))
    assert {s: v[2:] for s, v in found.items()} == expected


def test_two_buckets_make_a_window(spark):
    rows = [
        event("ABCUSDT", 4_000, 20.0, 350.0, 3, None, 5),
        event("ABCUSDT", 6_200, 21.0, 450.0, 2, None, 6),
    ]
    stats = baseline(
        spark, std_return_5m=0.5, mean_quote_volume_5m=500.0, std_quote_volume_5m=60.0,
        median_quote_volume_5m=600.0, sample_count=70,
    )
    settings = params.Params(min_liquidity=0.0)
    (row,) = as_dicts(hybrid.hybrid_from_buckets(frame(spark, rows), stats, 6500, settings))
    assert (row["quote_volume_5m"], row["trade_count_5m"], row["is_spike"]) == (800.0, 5, True)
    assert row["baseline_sample_count"] == 70
    same = [rows[0], event("ABCUSDT", 4_700, 21.0, 450.0, 2, None, 6)]
    assert hybrid.hybrid_from_buckets(frame(spark, same), stats, 6500, settings).count() == 0


def test_bucket_across_the_cutoff_stays_whole(spark):
    rows = [
        event("A", 100, 1.0, 1.0, 1, None, 1),
        event("A", 900, 2.0, 2.0, 1, None, 2),
        event("A", 5_500, 3.0, 4.0, 1, None, 3),
    ]
    (row,) = as_dicts(bk.latest_bucket_window(frame(spark, rows), "5 seconds"))
    assert (row["start_price"], row["quote_volume_5m"], row["window_start"]) == (1.0, 7.0, 100)


@pytest.mark.parametrize("seed", [5, 6])
def test_buckets_do_not_depend_on_how_input_is_split(spark, seed):
    rows = random_rows(seed)
    rng = random.Random(seed)
    whole = sorted(map(str, bk.time_buckets(frame(spark, rows)).collect()))
    parts = [[], [], []]
    for row in rows:
        rng.choice(parts).append(row)
    split = [bk.time_buckets(frame(spark, part)) for part in parts]
    for order in itertools.islice(itertools.permutations(split), 2):
        assert sorted(map(str, bk.merge_buckets(*order).collect())) == whole
    nested = bk.merge_buckets(bk.merge_buckets(split[2], split[0]), split[1])
    assert sorted(map(str, nested.collect())) == whole


def test_state_rows_and_back(spark):
    buckets = bk.time_buckets(frame(spark, random_rows(7)))
    state = bk.bucket_state(buckets)
    assert state.schema.simpleString() == schemas.BUCKET_STATE.simpleString()
    back = bk.explode_state(state).select(*buckets.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, buckets.collect()))
    for row in state.collect():
        starts = [b["bucket_start"] for b in row["buckets"]]
        assert starts == sorted(starts)


def test_legacy_lists(spark):
    items = spark.createDataFrame(
        [
            ("41", "trend", 1, "GONEUSDT"), ("52", "spike", 1, "XYZUSDT"),
            ("52", "trend", 2, "ABCUSDT"), ("52", "trend", 1, "KLMUSDT"),
            ("52", "trend", None, "ZZZUSDT"),
        ],
        "window_end string, result_type string, rank long, symbol string",
    )
    trending, spikes = serving.serving_lists(items)
    assert [r["symbol"] for r in trending.collect()] == ["KLMUSDT", "ABCUSDT", "ZZZUSDT"]
    assert [r["symbol"] for r in spikes.collect()] == ["XYZUSDT"]
    assert serving.newest_window_end(items).first()[0] == 52


HYBRID = "window_end string, symbol string, view_type string, trend_score double, spike_zscore double, is_spike boolean"


def test_hybrid_lists_span_the_freshness_window(spark):
    rows = [
        ("250000", "ABCUSDT", "hybrid", 0.75, 5.0, True),
        ("241000", "XYZUSDT", "hybrid", 3.25, 2.0, False),
        ("220000", "EDGEUSDT", "hybrid", 0.25, -8.0, True),
        ("219999", "STALEUSDT", "hybrid", 9.0, 9.0, True),
        ("240000", "XYZUSDT", "hybrid", 6.0, 2.0, True),
    ]
    trending, spikes = serving.serving_lists(spark.createDataFrame(rows, HYBRID))
    assert [(r["symbol"], r["rank"]) for r in trending.orderBy("rank").collect()] == [
        ("XYZUSDT", 1), ("ABCUSDT", 2), ("EDGEUSDT", 3),
    ]
    assert [(r["symbol"], r["spike_rank"], r["rank"]) for r in spikes.orderBy("spike_rank").collect()] == [
        ("EDGEUSDT", 1, 3), ("ABCUSDT", 2, 2),
    ]
    empty = spark.createDataFrame([], HYBRID + ", result_type string, rank long")
    assert [df.count() for df in serving.serving_lists(empty)] == [0, 0]


def test_stored_rows_and_expiry(spark):
    rows = [("250000", "ABCUSDT", "hybrid", 0.75, 5.0, True, 1, 1)]
    both = spark.createDataFrame(rows, HYBRID + ", rank long, spike_rank long")
    stored = serving.serving_rows(both, both, 500)
    keys = {(r["result_key"], r["rank"], r["expires_at"]) for r in stored.collect()}
    assert keys == {("trend#ABCUSDT", 1, 500), ("spike#ABCUSDT", 1, 500)}
    assert serving.unexpired(stored, 499).count() == 2
    assert serving.unexpired(stored, 500).count() == 0
    # Rows with a result key are ranked when stored, so the hybrid branch must not take them.
    trending, spikes = serving.serving_lists(stored)
    assert [r["result_key"] for r in trending.collect()] == ["trend#ABCUSDT"]
    assert [r["result_key"] for r in spikes.collect()] == ["spike#ABCUSDT"]


def test_snapshot_document(spark):
    rows = spark.createDataFrame([("B", 2.0, 2), ("A", 3.0, 1)], "symbol string, trend_score double, rank long")
    none = spark.createDataFrame([], "symbol string, spike_rank long")
    (row,) = snapshot_document(rows, none).collect()
    assert json.loads(row["value"]) == {
        "spikes": [],
        "trending": [{"symbol": "A", "trend_score": 3.0}, {"symbol": "B", "trend_score": 2.0}],
    }


def test_no_cross_join_and_no_range_frame_over_a_symbol(spark):
    events = frame(spark, random_rows(8))
    plan = sliding_windows(events, "5 seconds")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "RangeFrame" not in plan and "hashpartitioning(symbol" in plan
