"""The command lines, end to end on small files."""

from __future__ import annotations

import base64
import json

import pytest
from samples import START, as_dicts, minute_rows
from test_streams import write_files

from tickloom import schemas
from tickloom.jobs import backfill, batch, results, speed
from tickloom.sources.events import read_events
from tickloom.streaming.serving import DOCUMENT, STORED_ROW
from tickloom.streaming.tables import KeyedTable, Published


@pytest.mark.parametrize("state", ["buckets", "records"])
def test_batch_then_speed(spark, tmp_path, state):
    rows = minute_rows()
    folder = write_files(tmp_path / "in", [rows])
    out = tmp_path / "out"
    assert batch.main([folder, str(out), '{"dedupe": true, "median": "exact"}']) == 0
    options = ["--sliding"] if state == "records" else []
    assert speed.main(
        [folder, f"{out}/baselines-json", f"{out}/s", '{"min_liquidity": 0, "top_n": 1}', "--drain", *options]
    ) == 0
    published = Published(spark, f"{out}/s/serving/document", DOCUMENT).current()
    document = json.loads(published.first()["value"])
    assert len(document["trending"]) == 1 and document["spikes"] == []
    stored = as_dicts(KeyedTable(spark, f"{out}/s/serving/rows", STORED_ROW, "result_key", 1).current())
    assert [r["result_key"] for r in stored] == [f"trend#{document['trending'][0]['symbol']}"]
    assert stored[0]["rank"] == 1 and stored[0]["expires_at"] > 0


def test_speed_sets_bad_lines_apart(spark, tmp_path):
    folder = write_files(tmp_path / "in", [minute_rows()])
    with open(f"{folder}/bad.json", "w") as file:
        file.write('{"symbol":\n')
    out = tmp_path / "out"
    batch.main([folder, str(out)])
    speed.main([folder, f"{out}/baselines-json", f"{out}/s", '{"min_liquidity": 0}', "--drain"])
    bad = spark.read.text(f"{out}/s/quarantine").select("value").collect()
    assert [r["value"] for r in bad] == ['{"symbol":']
    assert KeyedTable(spark, f"{out}/s/serving/rows", STORED_ROW, "result_key", 1).current().count() == 2


def test_speed_over_records_counts_a_redelivered_one_once(spark, tmp_path):
    rows = minute_rows()
    folder = write_files(tmp_path / "in", [rows])
    out = tmp_path / "out"
    batch.main([folder, str(out)])
    records = tmp_path / "records"
    records.mkdir()
    names = schemas.EVENT.fieldNames()
    for copy in range(2):
        lines = []
        for i, row in enumerate(rows):
            data = base64.b64encode(json.dumps(dict(zip(names, row))).encode()).decode()
            lines.append(json.dumps({"data": data, "event_id": f"shard-{i % 2}:{i}", "sequence_number": str(i)}))
        (records / f"{copy}.json").write_text("\n".join(lines) + "\n")
    options = ['{"min_liquidity": 0}', "--records", "--drain"]
    speed.main([str(records), f"{out}/baselines-json", f"{out}/s", *options])
    served = as_dicts(KeyedTable(spark, f"{out}/s/serving/rows", STORED_ROW, "result_key", 1).current())
    volumes = {r["symbol"]: r["quote_volume_5m"] for r in served}
    assert volumes == {
        symbol: sum(r[6] for r in rows if r[2] == symbol and r[4] >= START + 4 * 60_000)
        for symbol in ("ABCUSDT", "XYZUSDT")
    }


def test_backfill_adds_days_and_keeps_others(spark, tmp_path):
    folder = tmp_path / "archive" / "ABCUSDT"
    folder.mkdir(parents=True)
    day = 86_400_000
    for i, name in enumerate(("2027-01-01", "2027-01-02", "2027-01-03")):
        time = 1_798_761_600_000 + i * day
        lines = [f"{i},40.0,1.5,70,74,{time},True,True", f"{90 + i},1.0,1.0,1,1,{time + 9 * day},True,True"]
        (folder / f"ABCUSDT-{name}.csv").write_text("\n".join(lines) + "\n")
    source, target = str(tmp_path / "archive"), str(tmp_path / "out")

    def ids():
        return sorted(r["trade_id"] for r in read_events(spark, target).collect())

    backfill.main([source, target, "2027-01-01", "abcusdt", "xyzusdt"])
    assert ids() == [0]
    backfill.main([source, target, "2027-01-02..2027-01-02", "abcusdt"])
    assert ids() == [0, 1]
    (folder / "ABCUSDT-2027-01-01.csv").write_text("55,40.0,1.5,70,74,1798761600000,True,True\n")
    backfill.main([source, target, "2027-01-01..2027-01-03", "abcusdt"])
    assert ids() == [0, 1, 2]
    backfill.main([source, target, "2027-01-01", "abcusdt", "--replace"])
    assert ids() == [1, 2, 55]
    with pytest.raises(ValueError):
        backfill.main([source, target, "2027-01-01", "ETHUPUSDT"])


def test_results(spark, tmp_path):
    head = "data_source,environment,cluster_id,step_id,worker_count,repeat,input_records,runtime_seconds,state,started_at,ended_at\n"
    (tmp_path / "runs.csv").write_text(head + "a,e,c,s,1,1,100,2.0,COMPLETED,2026-08-02T20:48:09Z,2026-08-02T20:49:05Z\n")
    (tmp_path / "scaling.csv").write_text(
        "timestamp,elapsed_seconds,step_id,step_state,requested_workers,running_workers,policy_state,yarn_memory_available_pct\n"
        "2026-08-02T15:52:58Z,0,s,PENDING,1,1,ATTACHED,100.0\n2026-08-02T16:52:58Z,3600,s,RUNNING,3,2,ATTACHED,5.0\n"
    )
    results.main(
        ["--input-csv", str(tmp_path / "runs.csv"), "--output-csv", str(tmp_path / "summary"),
         "--scaling-csv", str(tmp_path / "scaling.csv"), "--scaling-output", str(tmp_path / "timeline")]
    )
    (row,) = as_dicts(spark.read.option("header", "true").csv(str(tmp_path / "summary")))
    assert (row["median_runtime_seconds"], row["records_per_second"]) == ("2.0", "50.0")
    (row,) = as_dicts(spark.read.option("header", "true").csv(str(tmp_path / "timeline")))
    assert (row["peak_requested_workers"], row["observation_seconds"]) == ("3", "3600")
