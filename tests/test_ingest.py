"""Parsers, archives, baselines and logs."""

from __future__ import annotations

import base64
import gzip
import json
import statistics
from datetime import date

import pytest
from pyspark.sql import functions as F
from samples import BASELINE, START, as_dicts, baseline, event, frame, minute_rows

from tickloom import schemas
from tickloom.functions import events as fn
from tickloom.operators import metrics, replay
from tickloom.operators.clean import restrict_symbols, spot_events
from tickloom.sinks import tables
from tickloom.sources import archive, logs, messages
from tickloom.sources.baselines import read_baselines
from tickloom.sources.events import create_events_table, split_malformed

TRADE = {"e": "aggTrade", "E": 1767225605000, "s": "KLMUSDT", "a": 77, "p": "31.5", "q": "4"}


def parsed(spark, *texts):
    lines = spark.createDataFrame([(t if isinstance(t, str) else json.dumps(t),) for t in texts], "value string")
    return as_dicts(messages.parse_messages(lines, F.lit(1767225605900)))


def test_wrapped_and_bare_messages(spark):
    wrapped = {"stream": "klmusdt@aggTrade", "data": TRADE}
    rows = parsed(spark, wrapped, TRADE, {**TRADE, "data": 5})
    assert len(rows) == 3
    for row in rows:
        assert list(row) == list(schemas.EVENT_COLUMNS)
        assert (row["symbol"], row["quote_volume"], row["trade_id"]) == ("KLMUSDT", 126.0, 77)
        assert (row["ingest_time"], row["trade_count"], row["schema_version"]) == (1767225605900, 1, 2)


def test_unusable_messages_give_no_row(spark):
    bad = [
        {**TRADE, "e": "trade"}, {**TRADE, "s": "BTCBUSD"}, {**TRADE, "s": "ETHUPUSDT"},
        {**TRADE, "p": "n/a"}, {k: v for k, v in TRADE.items() if k != "q"}, {**TRADE, "a": "x"},
        {k: v for k, v in TRADE.items() if k != "E"}, [TRADE], 5, "not json", {"data": {"e": "x"}},
    ]
    assert parsed(spark, *bad) == []


def test_message_clock_in_microseconds(spark):
    (row,) = parsed(spark, {**TRADE, "E": 1767225605000123, "s": "klmusdt"})
    assert (row["event_time"], row["symbol"]) == (1767225605000, "KLMUSDT")


def test_records_carry_shard_and_sequence(spark):
    payload = base64.b64encode(json.dumps({"symbol": "btcusdt", "event_time": 5}).encode()).decode()
    rows = [
        (payload, "shard-1:77", "100"), (payload, "shard-1:77", None), (payload, None, None),
        (payload, "shard-2", None), (payload, "shard-3:4:5", None),
    ]
    df = spark.createDataFrame(rows, "data string, event_id string, sequence_number string")
    found = [(r["symbol"], r["_shard_id"], r["_sequence"]) for r in messages.decode_records(df).collect()]
    assert found == [
        ("BTCUSDT", "shard-1", "100"), ("BTCUSDT", "shard-1", "77"), ("BTCUSDT", "unknown", "0"),
        ("BTCUSDT", "shard-2", "0"), ("BTCUSDT", "shard-3", "4:5"),
    ]


def test_connector_rows(spark):
    rows = [(bytearray(json.dumps({"symbol": "btcusdt", "trade_id": 5}).encode()), "trades", 3, 42)]
    df = spark.createDataFrame(rows, "value binary, topic string, partition int, offset long")
    (row,) = as_dicts(messages.decode_stream_rows(df))
    assert (row["symbol"], row["trade_id"]) == ("BTCUSDT", 5)
    assert (row["_shard_id"], row["_sequence"]) == ("trades-3", "42")
    generated = messages.read_record_stream(spark, "rate", {"rowsPerSecond": "1"})
    assert generated.isStreaming


def test_sequences_compare_as_numbers(spark):
    big, bigger = "9" * 40, "1" + "0" * 40
    cases = [
        ("10", "9", True), ("9", "10", False), ("5", "5", False), ("5", None, True),
        (bigger, big, True), (big, bigger, False), ("007", "6", True), ("b", "a", True),
        ("a", "b", False), ("10", "9x", False),
    ]
    df = spark.createDataFrame(cases, "sequence string, previous string, expected boolean")
    found = df.select(replay.sequence_after(F.col("sequence"), F.col("previous")).alias("new"), "expected")
    assert all(r["new"] == r["expected"] for r in found.collect())


def test_replay_keeps_low_sequences_with_late_times(spark):
    rows = [("A", "s", "2", 10, 1.0), ("A", "s", "1", 20, 2.0), ("A", "s", "1", 20, 2.0)]
    schema = "symbol string, _shard_id string, _sequence string, event_time long, last_price double"
    batch = spark.createDataFrame(rows, schema)
    assert replay.new_records(batch).count() == 2
    after = replay.advance_checkpoints(batch)
    assert [tuple(r) for r in after.collect()] == [("A", "s", "2")]
    assert replay.new_records(batch, after).count() == 0


def test_archive_rows(spark):
    rows = [
        ("agg_trade_id", "price", "quantity", "first", "last", "time", "m", "b"),
        ("31", "40.0", "1.5", "70", "74", "1798761600000", "True", "True"),
        ("32", "40.0", "1.5", "74", "70", "1798761600017891", "True", "True"),
        (None, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, schemas.ARCHIVE_ROW)
    first, second = as_dicts(archive.normalise_archive(df, F.lit("abcusdt")))
    assert (first["symbol"], first["quote_volume"], first["trade_count"]) == ("ABCUSDT", 60.0, 5)
    assert (first["base_asset"], first["source"]) == ("ABC", archive.ARCHIVE_SOURCE)
    assert second["event_time"] == second["ingest_time"] == 1798761600017
    assert second["trade_count"] == 1


def test_archive_symbol_comes_from_the_folder(spark, tmp_path):
    folder = tmp_path / "ABCUSDT"
    folder.mkdir()
    (folder / "ABCUSDT-2027-01-01.csv").write_text(
        "id,p,q,f,l,t,m,b\n31,40.0,1.5,70,74,1798761600000,True,True\n"
    )
    (row,) = as_dicts(archive.normalise_archive(archive.read_archive(spark, str(tmp_path))))
    assert (row["symbol"], row["trade_id"]) == ("ABCUSDT", 31)


def test_backfill_skips_what_exists(spark, tmp_path):
    done = tmp_path / "symbol=ABCUSDT" / "date=2027-01-02"
    done.mkdir(parents=True)
    (done / "part-0.txt.gz").write_bytes(gzip.compress(b"{}\n"))
    (tmp_path / "other.txt").write_text("x")
    existing = archive.existing_outputs(spark, str(tmp_path))
    assert [tuple(r) for r in existing.collect()] == [("ABCUSDT", date(2027, 1, 2))]
    assert archive.existing_outputs(spark, str(tmp_path / "nowhere")).count() == 0
    symbols = spark.createDataFrame([("ABCUSDT",), ("XYZUSDT",)], "symbol string")
    start, end = date(2027, 1, 1), date(2027, 1, 3)
    todo = archive.backfill_manifest(symbols, start, end, existing)
    assert todo.count() == 5
    assert todo.where("symbol = 'ABCUSDT' AND day = '2027-01-02'").count() == 0
    assert archive.backfill_manifest(symbols, start, end, existing, overwrite=True).count() == 6
    assert archive.available_days(todo, existing).count() == 0
    with pytest.raises(ValueError):
        archive.backfill_manifest(symbols, end, start)


def test_backfill_output_is_gzip_json_by_symbol_and_day(spark, tmp_path):
    tables.write_events_by_day(frame(spark, minute_rows()), str(tmp_path / "out"))
    (part,) = (tmp_path / "out" / "symbol=ABCUSDT" / "date=2027-01-01").glob("*.gz")
    first = gzip.decompress(part.read_bytes()).decode().splitlines()[0]
    row = json.loads(first)
    assert list(row) == sorted(row) and row["symbol"] == "ABCUSDT" and " " not in first


def test_symbol_tests(spark):
    names = ["BTCUSDT", "btcusdt", "BTCBUSD", "ETHUPUSDT", "XDOWNUSDT", "ABULLUSDT", "ABEARUSDT", "JUPUSDT"]
    df = spark.createDataFrame([(n,) for n in names], "symbol string")
    assert [r[0] for r in spot_events(df).collect()] == ["BTCUSDT", "btcusdt"]
    assert "JUPUSDT" in [r[0] for r in spot_events(df, allow=("jupusdt",)).collect()]
    wanted = spark.createDataFrame([("BTCUSDT",), ("BTCUSDT",)], "symbol string")
    assert restrict_symbols(df, wanted).count() == 1
    assert restrict_symbols(df, ["BTCUSDT"]).count() == 1


@pytest.mark.parametrize(
    "text,expected",
    [
        (" btcusdt, ETHUSDT ,,ethusdt", ["BTCUSDT", "ETHUSDT"]),
        ("BTCBUSD,ETHUPUSDT", None),
        ("", None),
        (None, None),
    ],
)
def test_symbol_list(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(fn.symbol_list("t")).first()[0] == expected


def test_malformed_lines_are_set_apart(spark):
    lines = spark.createDataFrame(
        [('{"symbol":"A","event_time":1}',), ('{"symbol":',), ("",), ("  ",)], "value string"
    )
    good, bad = split_malformed(lines)
    assert [r["symbol"] for r in good.collect()] == ["A"]
    assert [r["raw"] for r in bad.collect()] == ['{"symbol":']


def test_quarantine_and_lenient_catalog_table(spark, tmp_path):
    text = '{"symbol":"A","event_time":1}\n{"symbol":\n'
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part").write_text(text)
    _, bad = split_malformed(spark.read.text(str(tmp_path / "in")))
    tables.write_quarantine(bad, str(tmp_path / "errors"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "errors")).collect()] == ['{"symbol":']
    create_events_table(spark, str(tmp_path / "in"), "events_with_bad_lines")
    assert [r["symbol"] for r in spark.table("events_with_bad_lines").collect()] == ["A"]


LAYOUTS = {
    "lines": lambda rows: "".join(json.dumps(r) + "\n" for r in rows),
    "array": lambda rows: json.dumps(rows),
    "pretty array": lambda rows: json.dumps(rows, indent=2),
    "envelope": lambda rows: json.dumps({"schema_version": 2, "baselines": rows}),
    "pretty envelope": lambda rows: json.dumps({"schema_version": 2, "baselines": rows}, indent=2),
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_baseline_layouts(spark, tmp_path, layout):
    rows = [BASELINE, {"symbol": "ethusdt", "mean_return_5m": 1}]
    (tmp_path / "b.json").write_text(LAYOUTS[layout](rows))
    for path in (tmp_path / "b.json", tmp_path):
        found = {r["symbol"]: r for r in as_dicts(read_baselines(spark, str(path)))}
        assert set(found) == {"ABCUSDT", "ETHUSDT"}
        assert found["ABCUSDT"] == BASELINE
        assert found["ETHUSDT"]["std_trade_count_5m"] == 0.0
        assert (found["ETHUSDT"]["sample_count"], found["ETHUSDT"]["updated_at"]) == (0, "")


@pytest.mark.parametrize("indent", [None, 2])
def test_single_baseline_object(spark, tmp_path, indent):
    (tmp_path / "b.json").write_text(json.dumps(BASELINE, indent=indent))
    (row,) = as_dicts(read_baselines(spark, str(tmp_path)))
    assert row == BASELINE


def named(*names):
    return [{**BASELINE, "symbol": n} for n in names]


def test_layouts_mixed_in_one_folder(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"baselines": named("A", "B")}, indent=2))
    (tmp_path / "b.json").write_text("".join(json.dumps(r) + "\n" for r in named("C", "D", "E")))
    first, second = map(json.dumps, named("F", "G"))
    (tmp_path / "c.json").write_text(f"[{first}\n,{second}]")
    (tmp_path / "d.json").write_text(json.dumps(named("H", "I")))
    found = sorted(r["symbol"] for r in read_baselines(spark, str(tmp_path)).collect())
    assert found == list("ABCDEFGHI")
    (tmp_path / "e.json").write_text('{"symbol": "J"\n')
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        read_baselines(spark, str(tmp_path)).count()


def test_all_baseline_parts_are_read(spark, tmp_path):
    for i, name in enumerate(("AUSDT", "BUSDT")):
        (tmp_path / f"part-0000{i}.json").write_text(json.dumps({**BASELINE, "symbol": name}) + "\n")
    assert read_baselines(spark, str(tmp_path)).count() == 2


def test_envelope_document(spark, tmp_path):
    rows = baseline(spark).unionByName(baseline(spark, symbol="AUSDT"))
    for name, some in (("two", rows), ("none", rows.where("symbol = 'x'"))):
        tables.write_baseline_envelope(some, str(tmp_path / name), "then")
        (part,) = (tmp_path / name).glob("part-*")
        document = json.loads(part.read_text())
        assert (document["schema_version"], document["generated_at"]) == (2, "then")
        assert document["view_type"] == "batch_baseline"
        assert [b["symbol"] for b in document["baselines"]] == (["ABCUSDT", "AUSDT"] if name == "two" else [])


RUNS = [(1, 40.25), (1, 42.5), (1, 44.0), (2, 25.5), (2, 21.0), (2, 23.75),
        (4, 14.5), (4, 12.0), (4, 16.25)]
RECORDS = 1_200_000


def expected_summary():
    out = []
    for workers in (1, 2, 4):
        own = [seconds for w, seconds in RUNS if w == workers]
        middle = statistics.median(own)
        gain = 42.5 / middle
        out.append(
            (workers, 3, middle, round(statistics.stdev(own), 3), min(own), max(own), round(gain, 4),
             round(gain / workers, 4), round(RECORDS / middle, 2))
        )
    return out


def run_log(spark, tmp_path, runs):
    lines = ["data_source,environment,cluster_id,step_id,worker_count,repeat,input_records,"
             "runtime_seconds,state,started_at,ended_at"]
    for i, (workers, seconds) in enumerate(runs):
        lines.append(f"archive,lab,c,s{i},{workers},{i},{RECORDS},{seconds},COMPLETED,"
                     "2027-02-03T10:00:01.250000+05:30,2027-02-03T10:01:02.500000+05:30")
    lines.append("archive,lab,c,x,1,9,1200000,1.0,FAILED,2027-02-03T10:00:01+05:30,2027-02-03T10:01:02+05:30")
    (tmp_path / "runs.csv").write_text("\n".join(lines) + "\n")
    return logs.read_run_log(spark, str(tmp_path / "runs.csv"))


def test_run_summary(spark, tmp_path):
    rows = metrics.run_summary(run_log(spark, tmp_path, RUNS)).collect()
    assert [tuple(r)[2:4] + tuple(r)[5:] for r in rows] == expected_summary()
    assert rows[0]["input_records"] == RECORDS
    with pytest.raises(Exception, match="no completed one-worker run"):
        metrics.run_summary(run_log(spark, tmp_path, RUNS[3:])).collect()


def test_latency_summary(spark):
    rows = spark.createDataFrame(
        [("A", 100, 10), ("A", 100, 12), ("A", 200, 0), ("B", 50, 99)],
        "symbol string, window_end long, latency_ms long",
    )
    samples = metrics.latency_samples(rows, 100)
    (found,) = as_dicts(metrics.latency_summary(samples))
    assert found == {
        "latency_samples": 2, "minimum_latency_ms": 0.0, "maximum_latency_ms": 10.0,
        "p50_latency_ms": 5.0, "p95_latency_ms": 9.5, "p99_latency_ms": 9.9,
    }
    (empty,) = as_dicts(metrics.latency_summary(metrics.latency_samples(rows, 1000)))
    assert set(empty.values()) == {0, 0.0}


def test_scaling_summary(spark):
    rows = [(0, 1, 1, 95.0), (30, 4, 2, 7.5), (90, 2, 4, 50.0), (1200, 1, 1, 91.0)]
    df = spark.createDataFrame(
        rows,
        "elapsed_seconds int, requested_workers int, running_workers int, yarn_memory_available_pct double",
    )
    (row,) = as_dicts(metrics.scaling_summary(df))
    assert list(row.values()) == [1, 4, 4, 1, 7.5, 95.0, 1200]


def test_event_counts(spark):
    df = frame(spark, [event("A", 1, 1.0), event("A", 2, 1.0), event("B", 1, 1.0)])
    assert tuple(metrics.event_counts(df).first()) == (3, 2)
    assert tuple(metrics.event_counts(df.where("false")).first()) == (0, 0)


def test_a_document_over_many_splits_is_put_together_in_order(spark, tmp_path):
    symbols = [f"S{i:03d}" for i in range(300)]
    (tmp_path / "a.json").write_text(json.dumps({"baselines": named(*symbols)}, indent=2))
    (tmp_path / "b.json").write_text("\n".join(json.dumps(row) for row in named("X", "Y")))
    given = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
        found = [r["symbol"] for r in read_baselines(spark, str(tmp_path)).orderBy("symbol").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", given)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == [*symbols, "X", "Y"]
