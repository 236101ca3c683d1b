"""Cleaning, windows, baselines, views."""

from __future__ import annotations

import collections
import datetime
import json
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F
from samples import START, as_dicts, event, frame, minute_rows, random_rows

from tickloom import params, schemas
from tickloom.functions import events as fn
from tickloom.operators import baselines as base
from tickloom.operators import ranking
from tickloom.operators.clean import clean_events
from tickloom.operators.dedupe import dedupe_trades, split_repeated
from tickloom.operators.latest import latest_rows
from tickloom.operators import percentiles
from tickloom.operators.percentiles import exact_percentiles
from tickloom.operators.windows import event_windows
from tickloom.plans import views
from tickloom.plans.batch import run_batch
from tickloom.session import materialise
from tickloom.sinks import tables
from tickloom.sources import events as event_files
from tickloom.sources.baselines import read_baselines

def reference_baselines(rows, length=300_000):
    """Statistics of the brute-force windows of each symbol."""
    by_symbol = {}
    for (symbol, _), (first, last, volume, trades, *_) in sorted(reference_windows(rows, length).items()):
        by_symbol.setdefault(symbol, []).append(((last / first - 1) * 100, volume, trades))
    out = {}
    for symbol, windows in by_symbol.items():
        returns, volumes, trades = zip(*windows)
        out[symbol] = (
            statistics.fmean(returns), statistics.stdev(returns), statistics.fmean(volumes),
            statistics.stdev(volumes), statistics.median(volumes), statistics.fmean(trades),
            statistics.stdev(trades),
        )
    return out


def check_baselines(rows):
    expected = reference_baselines(minute_rows())
    for row in rows:
        found = (
            row["mean_return_5m"], row["std_return_5m"], row["mean_quote_volume_5m"],
            row["std_quote_volume_5m"], row["median_quote_volume_5m"],
            row["mean_trade_count_5m"], row["std_trade_count_5m"],
        )
        assert found == pytest.approx(expected[row["symbol"]], rel=1e-9)
        assert row["sample_count"] == 2
    assert {row["symbol"] for row in rows} == set(expected)


def test_windows_and_baselines(spark):
    windows = event_windows(clean_events(frame(spark, minute_rows())))
    expected = reference_windows(minute_rows(), 300_000)
    rows = as_dicts(windows)
    assert len(rows) == len(expected) == 4
    for row in rows:
        first, last, volume, trades, *_ = expected[row["symbol"], row["window_start"]]
        assert (row["first_price"], row["last_price"]) == (first, last)
        assert (row["quote_volume_5m"], row["trade_count_5m"]) == (volume, trades)
        assert row["return_5m"] == pytest.approx((last / first - 1) * 100, rel=1e-9)
        assert row["window_end"] == row["window_start"] + 300_000
        assert (row["record_count"], row["latency_ms"]) == (5, 350)
    check_baselines(as_dicts(base.baselines(windows, "now")))


def test_approximate_median_is_the_lower_middle(spark):
    windows = event_windows(clean_events(frame(spark, minute_rows())))
    rows = as_dicts(base.baselines(windows, "now", median="approx"))
    volumes = {}
    for (symbol, _), window in reference_windows(minute_rows(), 300_000).items():
        volumes.setdefault(symbol, []).append(window[2])
    assert {r["symbol"]: r["median_quote_volume_5m"] for r in rows} == {
        symbol: min(own) for symbol, own in volumes.items()
    }


def test_two_windows_give_one_baseline(spark):
    rows = [event("KLMUSDT", i * 60_000, 40.0 + 2 * i, 700.0, 6, i * 60_000 + 40, i) for i in range(10)]
    (row,) = as_dicts(base.baselines(event_windows(frame(spark, rows)), "now"))
    assert row["sample_count"] == 2
    assert row["mean_return_5m"] == pytest.approx(50 * (8 / 40 + 8 / 50))
    assert (row["mean_quote_volume_5m"], row["mean_trade_count_5m"]) == (3500.0, 30.0)


def reference_windows(rows, length, least=2):
    groups = {}
    for r in rows:
        groups.setdefault((r[2], r[4] - r[4] % length), []).append(r)
    result = {}
    for key, members in groups.items():
        if len(members) < least:
            continue
        members.sort(key=lambda r: (r[4], -1 if r[9] is None else r[9], r[5]))
        result[key] = (
            members[0][5], members[-1][5], sum(r[6] for r in members), sum(r[7] for r in members),
            len(members), members[0][4], members[-1][4], max(r[8] for r in members),
        )
    return result


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_windows_match_brute_force_in_any_order(spark, seed):
    rows = random_rows(seed)
    expected = reference_windows(rows, 5_000)
    windows = event_windows(frame(spark, rows), "5 seconds")
    found = {
        (r["symbol"], r["window_start"]): (
            r["first_price"], r["last_price"], r["quote_volume_5m"], r["trade_count_5m"],
            r["record_count"], r["first_event_time"], r["last_event_time"], r["last_ingest_time"],
        )
        for r in as_dicts(windows)
    }
    assert found == expected


@pytest.mark.parametrize("seed", [4, 5])
def test_ties_and_missing_ids_are_decided_alike_in_any_order(spark, seed):
    rng = random.Random(seed)
    rows = []
    for row in random_rows(seed, span=8_000):
        repeats = rng.choice([1, 1, 2, 3])
        rows += [(*row[:5], float(rng.randrange(1, 1000)), *row[6:]) for _ in range(repeats)]
    expected = reference_windows(rows, 5_000)
    for _ in range(2):
        rng.shuffle(rows)
        found = as_dicts(event_windows(frame(spark, rows), "5 seconds"))
        assert {
            (r["symbol"], r["window_start"]): (r["first_price"], r["last_price"]) for r in found
        } == {key: window[:2] for key, window in expected.items()}


@pytest.mark.parametrize("window", ["1 second", "5 minutes", "1 day", "30 days"])
def test_windows_hash_aggregate(spark, window):
    largest = 2**63 - 1
    rows = [event("A", 0, 3.0, trade_id=largest), event("A", 0, 2.0), event("A", 0, 5.0, trade_id=0)]
    windows = event_windows(frame(spark, rows), window)
    plan = windows._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    (row,) = as_dicts(windows)
    assert (row["first_price"], row["last_price"]) == (2.0, 3.0)


def test_times_before_1970_floor(spark):
    events = frame(spark, [event("A", -1, 1.0), event("A", -299_999, 2.0), event("A", 0, 3.0)])
    rows = as_dicts(event_windows(events, min_records=1))
    assert sorted(r["window_start"] for r in rows) == [-300_000, 0]


def test_closed_before_and_min_records(spark):
    events = frame(spark, minute_rows())
    assert event_windows(events, closed_before=START + 300_000).count() == 2
    assert event_windows(events, min_records=6).count() == 0


def test_clean_strict_and_lenient(spark):
    rows = [
        event("btcusdt", START * 1000 + 233, 5.0, 1.0, 2, START * 1000 + 1000, 7),
        event("ETHUSDT", START, 0.0, 1.0),
        event("ETHUSDT", START, 1.0, -1.0),
        (None, None, "XRPUSDT", None, START, 2.0, None, None, None, None),
        (None, None, None, None, START, 2.0, 1.0, 1, START, 1),
        (None, None, "XRPUSDT", None, None, 2.0, 1.0, 1, START, 1),
    ]
    (strict,) = as_dicts(clean_events(frame(spark, rows)))
    assert strict["symbol"] == "BTCUSDT" and strict["base_asset"] == "BTC"
    assert (strict["event_time"], strict["ingest_time"]) == (START, START + 1)
    lenient = as_dicts(clean_events(frame(spark, rows), lenient=True).where("symbol = 'XRPUSDT'"))
    assert [(r["quote_volume"], r["trade_count"], r["ingest_time"]) for r in lenient] == [
        (0.0, 1, START)
    ]


def test_timestamps_do_not_depend_on_the_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        events = clean_events(frame(spark, minute_rows()))
        starts = {r["window_start"] for r in as_dicts(event_windows(events))}
        assert starts == {START, START + 300_000}
        text = events.select(F.unix_millis("event_timestamp").alias("t")).agg(F.min("t")).first()[0]
        assert text == START
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_epoch_millis(spark):
    values = [1735689600000000, 1735689600000, 99_999_999_999_999, 100_000_000_000_000, 9007199254740993123, None]
    df = spark.createDataFrame([(v,) for v in values], "t long").select(fn.epoch_millis("t").alias("t"))
    assert [r["t"] for r in df.collect()] == [
        1735689600000, 1735689600000, 99_999_999_999_999, 100_000_000_000, 9007199254740993, None,
    ]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 999])
def test_percentiles_interpolate(spark, n):
    values = [float((i * 7919) % 1000) for i in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    rows = exact_percentiles(df, [], "v", (0.0, 0.5, 0.95, 0.99, 1.0)).collect()
    ordered = sorted(values)
    for row in rows:
        position = (n - 1) * row["quantile"]
        low, high = ordered[math.floor(position)], ordered[math.ceil(position)]
        assert row["value"] == pytest.approx(low + (high - low) * (position - math.floor(position)))


def test_percentiles_of_large_skewed_groups(spark):
    """One group with most rows, far beyond the size that is bracketed by its extremes."""
    rows = 400_000
    df = spark.range(rows).select(
        F.when(F.col("id") % 4 == 0, F.lit("b")).otherwise(F.lit("a")).alias("k"),
        (F.xxhash64("id") % 1_000_003).cast("double").alias("v"),
    )
    found = {
        (r["k"], r["quantile"]): r["value"]
        for r in exact_percentiles(df, ["k"], "v", (0.5, 0.95)).collect()
    }
    expected = df.groupBy("k").agg(F.percentile("v", F.array(F.lit(0.5), F.lit(0.95))).alias("p"))
    for row in expected.collect():
        assert [found[row["k"], 0.5], found[row["k"], 0.95]] == pytest.approx(row["p"])


def test_narrowed_percentiles_are_the_same(spark, monkeypatch):
    """Brackets narrowed until few candidates are left, with ties and very unequal widths."""
    df = spark.range(60_000).select(
        F.pmod("id", F.lit(3)).alias("k"),
        F.when(F.col("id") % 4 == 0, 7.0).otherwise(F.exp((F.xxhash64("id") % 1000) / 50.0)).alias("v"),
    )
    df = materialise(df, "values")
    quantiles = (0.0, 0.1, 0.5, 0.95, 0.99, 1.0)
    plain = {keys: sorted(map(tuple, exact_percentiles(df, list(keys), "v", quantiles).collect())) for keys in ((), ("k",))}
    monkeypatch.setattr(percentiles, "CANDIDATES", 3)
    monkeypatch.setattr(percentiles, "BINS", 8)
    for keys, want in plain.items():
        assert sorted(map(tuple, exact_percentiles(df, list(keys), "v", quantiles).collect())) == want


def test_percentiles_of_one_repeated_value(spark):
    df = spark.range(300_000).select(F.lit(5.0).alias("v"))
    (row,) = exact_percentiles(df, [], "v", (0.95,)).collect()
    assert row["value"] == 5.0


def test_single_window_has_zero_spread(spark):
    events = frame(spark, [event("A", 0, 1.0), event("A", 1, 2.0)])
    (row,) = as_dicts(base.baselines(event_windows(events), "now"))
    assert (row["std_return_5m"], row["std_trade_count_5m"], row["sample_count"]) == (0.0, 0.0, 1)


def test_views(spark):
    events = clean_events(frame(spark, minute_rows()))
    windows = event_windows(events)
    views.register_views(spark, events, windows)
    prices = {r["symbol"]: r for r in as_dicts(spark.table("latest_market_prices"))}
    last = {r[2]: r[5] for r in minute_rows()}
    assert {symbol: r["last_price"] for symbol, r in prices.items()} == last
    assert prices["ABCUSDT"]["ingestion_latency_ms"] == 350
    trending = as_dicts(spark.sql("SELECT * FROM trending_coins ORDER BY trend_rank"))
    # Each symbol has two windows, so each z-score is plus or minus 1 / sqrt(2).
    assert [r["trend_rank"] for r in trending] == [1, 2]
    order = sorted(trending, key=lambda r: (-r["trend_score"], r["symbol"]))
    assert trending == order
    assert all(abs(r["trend_score"]) < 1.5 for r in trending)
    assert spark.table("abnormal_price_spikes").count() == 0
    summary = {r["symbol"]: r for r in as_dicts(spark.table("market_summary"))}
    assert summary["XYZUSDT"]["event_count"] == 10
    assert summary["XYZUSDT"]["average_trade_price"] == pytest.approx(
        statistics.fmean(r[5] for r in minute_rows() if r[2] == "XYZUSDT")
    )


def test_views_show_windows_that_come_later(spark, tmp_path):
    path = str(tmp_path / "windows")
    length = 300_000
    rows = [event("A", w * length + i, 5.0 + i, 10.0, 1, None, w * 10 + i) for w in range(4) for i in range(2)]
    tables.write_windows(event_windows(frame(spark, rows)), path)
    event_files.create_windows_table(spark, path, "growing_windows")
    views.register_views(spark, frame(spark, rows), "growing_windows")
    (old,) = as_dicts(spark.table("trending_coins"))
    later = [event("A", 9 * length + i, 5.0 + 50 * i, 10.0, 1, None, 90 + i) for i in range(2)]
    added = event_windows(frame(spark, later)).select(spark.table("growing_windows").columns)
    added.write.insertInto("growing_windows")
    (new,) = as_dicts(spark.table("trending_coins"))
    assert new["window_end"] > old["window_end"] and new["return_5m_pct"] > old["return_5m_pct"]


def test_constant_price_has_no_spike(spark):
    rows = [event("A", w * 300_000 + i, 5.0, 10.0, 1, None, w * 10 + i) for w in range(4) for i in range(2)]
    windows = event_windows(frame(spark, rows))
    assert views.abnormal_history(windows).count() == 0
    (row,) = as_dicts(views.trending_coins(windows))
    assert row["trend_score"] == 0.0


def test_latest_row_breaks_ties_by_id(spark):
    rows = [event("A", 10, 1.0, trade_id=1), event("A", 10, 2.0, trade_id=3),
            event("A", 9, 4.0, trade_id=99)]
    (row,) = latest_rows(frame(spark, rows), ("last_price",)).collect()
    assert row["last_price"] == 2.0
    without_id = [*rows, event("A", 10, 3.0)]
    (row,) = latest_rows(frame(spark, without_id), ("last_price",)).collect()
    assert row["last_price"] == 2.0


def test_rank_over_slices(spark):
    df = spark.range(500).select(F.col("id").alias("symbol"), (F.col("id") % 7).alias("score"))
    ranked = ranking.rank_rows(df, [F.desc("score"), F.asc("symbol")], "place")
    found = [r["symbol"] for r in ranked.orderBy("place").collect()]
    assert found == sorted(range(500), key=lambda i: (-(i % 7), i))
    assert sorted(r["place"] for r in ranked.collect()) == list(range(1, 501))


def test_dedupe_keeps_rows_without_id(spark):
    rows = [event("A", 5, 1.0, trade_id=1)] * 3 + [event("A", 5, 1.0)] * 2 + [event("B", 5, 1.0, trade_id=1)]
    assert dedupe_trades(frame(spark, rows)).count() == 4


def test_batch_job_from_files(spark, tmp_path):
    folder = tmp_path / "in" / "2026" / "07"
    folder.mkdir(parents=True)
    names = schemas.EVENT.fieldNames()
    lines = [json.dumps({**dict(zip(names, row)), "source": "replay"}) for row in minute_rows()]
    (folder / "part.jsonl").write_text("\n".join(lines[:12]) + "\n\nnot json\n")
    (folder / "rest").write_text("\n".join(lines[12:]) + "\n")
    out = tmp_path / "out"
    run_batch(
        spark, str(tmp_path / "in"), f"{out}/b", "2026-07-02T00:00:00+00:00",
        json_output=f"{out}/j", batch_view_output=f"{out}/w",
    )
    check_baselines(as_dicts(spark.read.parquet(f"{out}/b")))
    check_baselines(as_dicts(read_baselines(spark, f"{out}/j")))
    assert sorted(p.name for p in (out / "w").glob("symbol=*")) == ["symbol=ABCUSDT", "symbol=XYZUSDT"]
    tagged = spark.read.parquet(f"{out}/b").first()
    assert (tagged["view_type"], tagged["schema_version"]) == ("batch_baseline", 2)
    assert tables.read_windows(spark, f"{out}/w").count() == 4


def test_strict_scan(spark, tmp_path):
    (tmp_path / "a.JSONL").write_text('{"symbol":"A","event_time":1}\n\n')
    (tmp_path / "plain").write_text('{"symbol":"B","event_time":1}\n')
    (tmp_path / "notes.txt").write_text("not json\n")
    rows = event_files.read_events_strict(spark, str(tmp_path)).collect()
    assert sorted(r["symbol"] for r in rows) == ["A", "B"]
    (tmp_path / "bad.json").write_text("not json\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        event_files.read_events_strict(spark, str(tmp_path)).collect()


def test_partitioned_catalog_table_prunes(spark, tmp_path):
    path = str(tmp_path / "w")
    tables.write_windows(event_windows(frame(spark, minute_rows())), path)
    event_files.create_windows_table(spark, path, "pruned_windows")
    df = spark.sql("SELECT * FROM pruned_windows WHERE symbol = 'XYZUSDT'")
    assert df.count() == 2
    assert "PartitionFilters: [isnotnull(symbol" in df._jdf.queryExecution().toString()


def test_newest_days_open_no_other_folders(spark, tmp_path):
    """B has been silent for a year: the days between its last ones and A's are not opened."""
    path, day = tmp_path / "t", 86_400_000
    rows = [event("A", START + d * day + i, 5.0, trade_id=d * 10 + i) for d in (0, 300, 364, 365) for i in range(2)]
    rows += [event("B", START + i, 5.0, trade_id=i) for i in range(2)]
    tables.write_event_table(frame(spark, rows), str(path))
    first = datetime.date(2027, 1, 1)
    for part in (path / f"date={first + datetime.timedelta(300)}").rglob("*.parquet"):
        part.write_bytes(b"broken")
    read = event_files.read_newest_days(spark, str(path))
    assert sorted(r["trade_id"] for r in read.collect()) == [0, 1, 3640, 3641, 3650, 3651]
    assert "dynamicpruning" in read._jdf.queryExecution().toString()


def test_event_table_prunes_and_replaces_days(spark, tmp_path):
    path, day = str(tmp_path / "t"), 86_400_000
    rows = [event(s, START + d * day + i, 5.0, trade_id=i) for s in ("A", "B") for d in range(3) for i in range(2)]
    tables.write_event_table(frame(spark, rows), path)
    tables.write_event_table(frame(spark, [event("A", START + day, 7.0, trade_id=9)]), path)
    first = datetime.date(2027, 1, 1)
    chosen = event_files.read_event_table(spark, path, since=first + datetime.timedelta(1), symbols=["A"])
    assert sorted((r["last_price"], r["trade_id"]) for r in chosen.collect()) == [(5.0, 0), (5.0, 1), (7.0, 9)]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: ["):]
    assert "date" in filters.split("]")[0] and "symbol" in filters.split("]")[0]
    assert event_files.read_event_table(spark, path).count() == 11


def test_durations():
    assert params.duration_ms("5 minutes") == 300_000
    assert params.duration_ms("1 Day") == 86_400_000
    for text in ("5", "0 seconds", "1 month", "five minutes"):
        with pytest.raises(ValueError):
            params.duration_ms(text)


def repeated_rows(seed: int, share: float):
    """Random trades, ``share`` of them a second time with another price, and one id very often."""
    rng = random.Random(seed)
    rows = random_rows(seed, n=300)
    again = [r[:5] + (r[5] + rng.randrange(3),) + r[6:] for r in rows if rng.random() < share]
    hot = [event("HOTUSDT", rng.randrange(0, 40_000, 250), 5.0, trade_id=10**9) for _ in range(100 if share else 1)]
    rows = rows + again + hot
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("longs", [1, 64, 1 << 20])
@pytest.mark.parametrize("share", [0.0, 0.1, 1.0])
def test_one_trade_per_id_whatever_the_filter_holds(spark, share, longs):
    rows = repeated_rows(7, share)
    got = sorted((tuple(r) for r in dedupe_trades(frame(spark, rows), longs).collect()), key=str)
    best = {}
    for r in rows:
        key = (r[2], r[9])
        rest = (r[4], *r[:2], r[3], *r[5:9])
        if r[9] is not None and (key not in best or rest < best[key][0]):
            best[key] = (rest, r)
    want = [r for _, r in best.values()] + [r for r in rows if r[9] is None]
    assert got == sorted(want, key=str)


def test_only_rows_of_repeated_trades_are_shuffled(spark):
    counts = []
    for share in (0.0, 0.1, 1.0):
        rows = repeated_rows(8, share)
        single, suspects = split_repeated(frame(spark, rows))
        counts.append(suspects.count())
        assert single.count() + counts[-1] == len(rows)
        ids = collections.Counter((r[2], r[9]) for r in rows if r[9] is not None)
        assert counts[-1] == sum(n for n in ids.values() if n > 1)
    assert counts[0] == 0 < counts[1] < counts[2]
    assert "Exchange hash" not in single._jdf.queryExecution().toString()
