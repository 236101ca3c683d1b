"""Streams against their batch forms: any split, any order, replays, late and missing data."""

from __future__ import annotations

import json
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from samples import START, as_dicts, baseline, event, frame, minute_rows, random_rows

from tickloom import schemas
from tickloom.operators import buckets as bk
from tickloom.operators.clean import clean_events
from tickloom.operators.sliding import latest_sliding
from tickloom.operators.windows import event_windows
from tickloom.registry import streams
from tickloom.sources.events import read_event_stream, read_events
from tickloom.streaming import sinks
from tickloom.streaming.aggregates import stream_dedupe, stream_windows
from tickloom.sinks.tables import write_baselines_json
from tickloom.sources.baselines import baseline_stamp, read_baselines
from tickloom.streaming.hybrid import HybridView, Refreshing, start
from tickloom.streaming.state import (
    WINDOW as WINDOW_COLUMNS,
    recent_bucket_windows,
    recent_record_windows,
    stored_buckets,
    stored_checkpoints,
    stored_records,
    stored_state,
)
from tickloom.streaming.tables import KeyedTable, Published, read_changes, write_changes

WINDOW = "5 seconds"


def lines(df):
    return sorted(map(str, df.collect()))


def write_files(folder, parts):
    """One JSON Lines file per part, in order of arrival."""
    folder.mkdir()
    names = schemas.EVENT.fieldNames()
    for i, part in enumerate(parts):
        rows = [json.dumps({k: v for k, v in zip(names, row) if v is not None}) for row in part]
        (folder / f"part-{i:03d}.json").write_text("\n".join(rows) + "\n")
    return str(folder)


def split(rows, n, seed):
    rng = random.Random(seed)
    parts = [[] for _ in range(n)]
    for row in rows:
        rng.choice(parts).append(row)
    return [part for part in parts if part]


def arriving(spark, folder, parts):
    return read_event_stream(spark, write_files(folder, parts), max_files_per_trigger=1)


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_windows_equal_batch_windows(spark, tmp_path, seed):
    rows = random_rows(seed)
    stream = clean_events(arriving(spark, tmp_path / "in", split(rows, 3, seed)))
    changes = str(tmp_path / "changes")
    query = (
        stream_windows(stream, WINDOW, "1 hour")
        .writeStream.outputMode("update")
        .foreachBatch(lambda df, batch_id: write_changes(df, batch_id, changes))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    found = read_changes(spark, changes, ["symbol", "window_start"])
    expected = event_windows(clean_events(frame(spark, rows)), WINDOW)
    assert found.columns == expected.columns
    assert lines(found) == lines(expected)


def test_rows_beyond_the_lateness_are_dropped(spark, tmp_path):
    parts = [
        [event("A", 1_000, 1.0, trade_id=1), event("A", 100_000, 1.0, trade_id=2)],
        [event("A", 101_000, 1.0, trade_id=3)],
        [event("A", 2_000, 9.0, trade_id=4), event("A", 99_500, 1.0, trade_id=5)],
    ]
    changes = str(tmp_path / "changes")
    query = (
        stream_windows(clean_events(arriving(spark, tmp_path / "in", parts)), WINDOW, WINDOW, 1)
        .writeStream.outputMode("update")
        .foreachBatch(lambda df, batch_id: write_changes(df, batch_id, changes))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    found = {r["window_start"]: r["record_count"] for r in read_changes(spark, changes, ["symbol", "window_start"]).collect()}
    assert found == {0: 1, 95_000: 1, 100_000: 2}


def test_stream_dedupe(spark, tmp_path):
    a, b = event("A", 1_000, 1.0, trade_id=1), event("A", 1_500, 2.0)
    other = event("B", 1_000, 1.0, trade_id=1)
    out = str(tmp_path / "out")
    query = (
        stream_dedupe(clean_events(arriving(spark, tmp_path / "in", [[a, b, a], [a, other], [b]])), "1 hour")
        .select("symbol", "trade_id")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    found = sorted((r["symbol"], r["trade_id"] or 0) for r in spark.read.parquet(out).collect())
    assert found == [("A", 0), ("A", 0), ("A", 1), ("B", 1)]


def collected(found):
    """A step that keeps the rows of each micro-batch in ``found``."""
    return lambda df, batch_id: found.append([tuple(r) for r in df.collect()])


def run(frame, step, checkpoint):
    query = start(frame, step, str(checkpoint))
    query.awaitTermination()
    return query.recentProgress


@pytest.mark.parametrize("seed", [3, 4])
def test_bucket_state_equals_batch_for_any_split(spark, tmp_path, seed):
    rows = random_rows(seed)
    stream = arriving(spark, tmp_path / "in", split(rows, 3, seed))
    found, checkpoint = [], str(tmp_path / "cp")
    run(recent_bucket_windows(stream, WINDOW, 1_000), collected(found), checkpoint)
    kept = bk.retain_recent(stored_buckets(spark, checkpoint), 5_000)
    expected = bk.retain_recent(bk.time_buckets(frame(spark, rows)), 5_000)
    assert lines(kept) == lines(expected)
    last = {row[0]: row for batch in found for row in batch}
    assert sorted(last.values()) == sorted(map(tuple, bk.roll_up_buckets(expected, 1).select(
        *[c if c != "records" else F.col("bucket_count") for c in WINDOW_COLUMNS.fieldNames()]
    ).collect()))


def test_record_state_equals_batch_for_any_split(spark, tmp_path):
    rows = [r if r[9] is not None else (*r[:9], 5_000 + i) for i, r in enumerate(random_rows(6))]
    stream = arriving(spark, tmp_path / "in", [*split(rows, 3, 6), rows[:50]])
    latest = KeyedTable(spark, str(tmp_path / "latest"), WINDOW_COLUMNS)
    run(recent_record_windows(stream, WINDOW), latest.merge, tmp_path / "cp")
    expected = latest_sliding(frame(spark, rows), WINDOW, 1, dedupe=True)
    found = latest.current().withColumnRenamed("records", "record_count").select(*expected.columns)
    assert lines(found) == lines(expected)


def test_only_the_keys_of_a_batch_are_written(spark, tmp_path):
    many = [event(f"S{i}", 1_000 + i, 1.0, trade_id=i) for i in range(300)]
    stream = arriving(spark, tmp_path / "in", [many, [event("S7", 1_500, 2.0, trade_id=900)]])
    found = []
    progress = run(recent_record_windows(stream, WINDOW), collected(found), tmp_path / "cp")
    written = [p["stateOperators"][0]["customMetrics"]["rocksdbPutCount"] for p in progress[:2]]
    assert written[1] * 20 < written[0]
    assert [len(batch) for batch in found[:2]] == [300, 1]
    assert found[1][0][5] == 2
    assert stored_records(spark, str(tmp_path / "cp")).count() == 301


def test_rows_without_id_all_count_and_ids_stay_whole(spark, tmp_path):
    large = 2**60 + 1
    rows = [event("A", 1_000, 1.0, 5.0), event("A", 1_000, 1.0, 5.0), event("A", 900, 2.0, 7.0, trade_id=large)]
    stream = arriving(spark, tmp_path / "in", [rows, rows[2:]])
    found = []
    run(recent_record_windows(stream, WINDOW), collected(found), tmp_path / "cp")
    assert found[:2] == [[("A", 2.0, 1.0, 17.0, 3, 3, 900, 1_000)]] * 2
    assert stored_records(spark, str(tmp_path / "cp")).agg(F.max("trade_id")).first()[0] == large


def sharded(spark, folder, parts):
    stream = arriving(spark, folder, parts)
    return stream.withColumns(
        {
            "_shard_id": F.concat(F.lit("s"), F.pmod(F.xxhash64("symbol"), F.lit(2)).cast("string")),
            "_sequence": F.coalesce("trade_id", F.lit(0)).cast("string"),
        }
    )


def test_redelivered_records_count_once_after_a_restart(spark, tmp_path):
    row = event("ABCUSDT", 7000, 20.0, 350.0, 1, None, 61)
    older = event("ABCUSDT", 6500, 20.0, 350.0, 1, None, 9)
    checkpoint = str(tmp_path / "cp")
    stream = sharded(spark, tmp_path / "in", [[row, row], [row]])
    run(recent_bucket_windows(stream), collected([]), checkpoint)
    (tmp_path / "in" / "later.json").write_text(
        "\n".join(json.dumps({k: v for k, v in zip(schemas.EVENT.fieldNames(), r) if v is not None}) for r in (row, older))
    )
    again = read_event_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1).withColumns(
        {
            "_shard_id": F.concat(F.lit("s"), F.pmod(F.xxhash64("symbol"), F.lit(2)).cast("string")),
            "_sequence": F.coalesce("trade_id", F.lit(0)).cast("string"),
        }
    )
    run(recent_bucket_windows(again), collected([]), checkpoint)
    (found,) = as_dicts(stored_state(spark, checkpoint, "5 minutes", 1_000))
    assert len(found["buckets"]) == 1
    assert found["buckets"][0]["quote_volume"] == 350.0
    assert list(found["checkpoints"].values()) == ["61"]
    assert found["newest_event_time"] == 7000
    assert [tuple(r)[::2] for r in stored_checkpoints(spark, checkpoint).collect()] == [("ABCUSDT", "61")]


def test_late_events_of_a_slow_symbol_are_not_lost(spark, tmp_path):
    """The cutoff is per symbol: another symbol's clock running ahead does not matter."""
    parts = [
        [event("FAST", 10_000_000, 1.0, trade_id=1)],
        [event("SLOW", 1_000, 1.0, trade_id=2), event("SLOW", 2_500, 1.0, trade_id=3)],
        [event("FAST", 1_000, 1.0, trade_id=4)],
    ]
    stream = arriving(spark, tmp_path / "in", parts)
    run(recent_bucket_windows(stream, WINDOW, 1_000), collected([]), tmp_path / "cp")
    found = {(r["symbol"], r["bucket_start"]) for r in stored_buckets(spark, str(tmp_path / "cp")).collect()}
    assert found == {("FAST", 10_000_000), ("SLOW", 1_000), ("SLOW", 2_000)}


@pytest.mark.parametrize("kind", ["buckets", "records"])
def test_state_of_a_silent_symbol_expires(spark, tmp_path, kind):
    build, stored = {
        "buckets": (lambda e: recent_bucket_windows(e, WINDOW, 1_000, 2), stored_buckets),
        "records": (lambda e: recent_record_windows(e, WINDOW, 2), stored_records),
    }[kind]
    folder, checkpoint = tmp_path / "in", str(tmp_path / "cp")

    def symbols_after(part, name):
        folder.mkdir(exist_ok=True)
        row = {k: v for k, v in zip(schemas.EVENT.fieldNames(), part) if v is not None}
        (folder / name).write_text(json.dumps(row))
        run(build(read_event_stream(spark, str(folder))), collected([]), checkpoint)
        return {r["symbol"] for r in stored(spark, checkpoint).collect()}

    assert symbols_after(event("A", 1_000, 1.0, trade_id=1), "1.json") == {"A"}
    time.sleep(3)
    assert symbols_after(event("B", 1_000, 1.0, trade_id=2), "2.json") == {"B"}


def test_touched_state_outlives_its_first_delivery(spark, tmp_path, monkeypatch):
    # by user the event ids, one minute apart in their order; the id modulo three is the delivery
    trades = {1: [0, 3], 2: [4, 6], 3: [9, 5], 4: [12, 7, 8], 5: [10], 6: [13, 15, 11], 7: [14, 18]}
    rows = [(i, at, u) for u, ids in trades.items() for at, i in enumerate(ids)]
    table = spark.createDataFrame(rows, "event_id long, at long, user_id long").selectExpr(
        "event_id",
        "user_id",
        f"timestamp_millis({START} + at * 60000) AS ts",
        "'view' AS event_type",
        "1.5D AS value",
        "'{\"k\": 1}' AS props",
    )
    table.write.parquet(f"{tmp_path}/events.parquet")
    # too short at first, so that the deliveries are made again
    monkeypatch.setattr(streams, "RETENTION_SECONDS", 0)
    found = {r["symbol"]: (r["newest"] - START) // 60_000 for r in streams.expiry_of_state(spark, str(tmp_path)).collect()}
    # a user of the first delivery alone has gone, one it left to the second has kept its newest time
    assert found == {"U2USDT": 1, "U3USDT": 1, "U4USDT": 2, "U5USDT": 0, "U6USDT": 2, "U7USDT": 0}


def windows(spark, *rows):
    return spark.createDataFrame(list(rows), WINDOW_COLUMNS)


def window(symbol, volume=20_000.0, records=2):
    return (symbol, 100.0, 101.0, volume, 10, records, 0, 1_000)


def test_expired_rows_leave_the_hybrid_view(spark, tmp_path):
    now = [0]
    stats = baseline(spark).unionByName(baseline(spark, symbol="BUSDT"))
    view = HybridView(spark, str(tmp_path / "view"), Refreshing(lambda: stats), clock_ms=lambda: now[0])
    for batch_id, (symbol, second) in enumerate([("ABCUSDT", 0), ("BUSDT", 899), ("BUSDT", 900)]):
        now[0] = second * 1000
        view(windows(spark, window(symbol), window("NONE"), window("ABCUSDT", records=1)), batch_id)
        served = {r["symbol"] for r in view.served().collect()}
        assert served == ({"ABCUSDT"}, {"ABCUSDT", "BUSDT"}, {"BUSDT"})[batch_id]


def test_hybrid_view_end_to_end(spark, tmp_path):
    rows = minute_rows()
    stats = baseline(spark, std_return_5m=0.5).unionByName(baseline(spark, symbol="OTHERUSDT"))
    view = HybridView(spark, str(tmp_path / "view"), Refreshing(lambda: stats), clock_ms=lambda: START + 600_000)
    stream = arriving(spark, tmp_path / "in", [rows[:4] + rows[10:], rows[4:10]])
    run(recent_bucket_windows(stream), view, tmp_path / "cp")
    (row,) = as_dicts(view.served())
    # Only the symbol with a baseline is served; its closed five minutes hold six buckets.
    assert row["symbol"] == "ABCUSDT"
    assert row["quote_volume_5m"] == sum(r[6] for r in rows[4:10])
    assert row["return_5m_pct"] == pytest.approx((rows[9][5] / rows[4][5] - 1) * 100)
    assert row["latency_ms"] == 60_000
    assert row["expires_at"] == START // 1000 + 600 + 900


def test_baselines_written_over_under_a_running_view(spark, tmp_path):
    folder, clock = str(tmp_path / "published"), [0.0]
    refreshing = Refreshing(
        lambda: read_baselines(spark, folder), 300, lambda: clock[0], lambda: baseline_stamp(spark, folder)
    )
    view = HybridView(spark, str(tmp_path / "view"), refreshing, clock_ms=lambda: 0)
    with pytest.raises(RuntimeError):
        refreshing.get()
    write_baselines_json(baseline(spark, symbol="OTHER"), folder)
    view(windows(spark, window("ABCUSDT")), 0)
    write_baselines_json(baseline(spark), folder)
    clock[0] = 299.0
    view(windows(spark, window("ABCUSDT")), 1)
    assert view.served().count() == 0
    clock[0] = 300.0
    (tmp_path / "published" / "_SUCCESS").rename(tmp_path / "aside")
    (tmp_path / "published" / "_temporary").mkdir()
    view(windows(spark, window("ABCUSDT")), 2)
    assert view.served().count() == 0
    (tmp_path / "published" / "_temporary").rmdir()
    (tmp_path / "aside").rename(tmp_path / "published" / "_SUCCESS")
    view(windows(spark, window("ABCUSDT")), 3)
    assert [r["symbol"] for r in view.served().collect()] == ["ABCUSDT"]


KEYED = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("x", T.LongType())])


def pairs(spark, **values):
    return spark.createDataFrame(list(values.items()), KEYED)


def test_keyed_table_replaces_and_repeats(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), KEYED)
    assert table.current().count() == 0
    table.merge(pairs(spark, a=1, b=1), 0)
    table.merge(pairs(spark, b=2, c=2), 1)
    table.merge(pairs(spark, b=2, c=2), 1)
    assert dict(map(tuple, table.current().collect())) == {"a": 1, "b": 2, "c": 2}
    table.merge(pairs(spark), 2)
    # a batch that fails before it publishes leaves the table as it was
    (tmp_path / "t" / "rows" / "batch=3" / "part=1").mkdir(parents=True)
    (tmp_path / "t" / "published" / "_3").write_text("{")
    for batch_id in range(3, 6):
        table.merge(pairs(spark, a=batch_id), batch_id)
    assert dict(map(tuple, table.current().collect())) == {"a": 5, "b": 2, "c": 2}
    assert sorted(f.name for f in (tmp_path / "t" / "published").iterdir() if f.name.isdigit()) == ["4", "5"]


def test_bytes_written_for_one_symbol_do_not_grow_with_the_others(spark, tmp_path):
    sizes = []
    for n in (20, 600):
        path = tmp_path / str(n)
        table = KeyedTable(spark, str(path), KEYED, parts=20 * n)
        table.merge(pairs(spark, **{f"s{i}": i for i in range(n)}).where("symbol < 's2' OR symbol > 's3'"), 0)
        table.merge(pairs(spark, s25=1), 1)
        sizes.append(sum(f.stat().st_size for f in (path / "rows" / "batch=1").rglob("*.parquet")))
    assert sizes[1] <= 2 * sizes[0]


def test_published_document_is_replaced_whole(spark, tmp_path):
    document = Published(spark, str(tmp_path / "d"), T.StructType([T.StructField("value", T.StringType())]))
    assert document.current().count() == 0
    for batch_id, text in enumerate(("one", "two")):
        document.write(spark.createDataFrame([(text,)], "value string"), batch_id)
    assert [r["value"] for r in document.current().collect()] == ["two"]


def test_archive_and_json_lines(spark, tmp_path):
    rows = minute_rows()
    folder = write_files(tmp_path / "in", [rows])
    stream = read_event_stream(spark, folder)
    sinks.archive_events(stream, str(tmp_path / "a"), str(tmp_path / "ca"), every=None).awaitTermination()
    parts = list((tmp_path / "a" / "date=2027-01-01" / "hour=00" / "symbol=ABCUSDT").glob("*.gz"))
    assert 1 <= len(parts) <= 4
    assert lines(read_events(spark, str(tmp_path / "a"))) == lines(frame(spark, rows))
    sinks.append_json_lines(stream, str(tmp_path / "j"), str(tmp_path / "cj")).awaitTermination()
    assert lines(spark.read.schema(schemas.EVENT).json(str(tmp_path / "j"))) == lines(frame(spark, rows))
    sinks.print_events(stream, str(tmp_path / "cc")).awaitTermination()
