from __future__ import annotations

import collections
import zlib

import cases
from pyspark.sql import functions as F

from tickloom.llm import shuffling
from tickloom.llm.shuffling import scatter_copies, scatter_key, shuffle_to_shards, write_shards


def placed(df):
    return cases.rows_of(df.select("record.doc_id", "record.text", "shard", "slot"))


def test_shards_differ_by_a_row_and_slots_have_no_gap(spark):
    rows = [(i, f"text {i}" * (i % 9), "en", "a", 0) for i in range(1000)]
    docs = cases.documents(spark, rows)
    out = shuffle_to_shards(docs, bucket_bytes=2000)
    got = placed(out)
    slots = collections.defaultdict(set)
    for _, _, shard, slot in got:
        slots[shard].add(slot)
    assert sorted(slots) == list(range(40))
    assert all(own == set(range(25)) for own in slots.values())
    assert sorted(r[0] for r in got) == list(range(1000))
    # the same places whatever the order of arrival
    assert placed(shuffle_to_shards(docs.repartition(7), bucket_bytes=2000)) == got
    order = [r[0] for r in sorted(got, key=lambda r: (r[3], r[2]))]
    assert sum(a < b for a, b in zip(order, order[1:])) in range(400, 600)


def test_places_do_not_depend_on_the_join(spark, monkeypatch):
    docs = cases.documents(spark, [(i, f"text {i}" * (i % 9), "en", "a", 0) for i in range(500)])
    got = placed(shuffle_to_shards(docs, bucket_bytes=2000))
    monkeypatch.setattr(shuffling, "BROADCAST_BUCKETS", 0)
    given = {name: spark.conf.get(name) for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for threshold, adaptive in (("-1", "true"), ("-1", "false"), ("10MB", "false")):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            assert placed(shuffle_to_shards(docs, bucket_bytes=2000)) == got
    finally:
        for name, value in given.items():
            spark.conf.set(name, value)


def test_buckets_are_shuffled_inside(spark):
    rows = [(i, "same size", "en", "a", 0) for i in range(200)]
    docs = cases.documents(spark, rows)
    one = shuffle_to_shards(docs, bucket_bytes=1 << 30)
    other = shuffle_to_shards(docs, bucket_bytes=1 << 30, seed=5)
    assert placed(one) != placed(other)
    key = F.xxhash64(F.lit(23), "doc_id", "text")
    by_hash = [r["doc_id"] for r in docs.orderBy(key).collect()]
    by_place = [r[0] for r in sorted(placed(one), key=lambda r: (r[3], r[2]))]
    assert by_hash != by_place


def test_odd_rows_and_files(spark, tmp_path):
    docs = cases.documents(spark, clashing=True)
    out = shuffle_to_shards(docs, shards=4, bucket_bytes=64)
    assert sorted((repr(r[0]), repr(r[1])) for r in placed(out)) == sorted(
        (repr(r[0]), repr(r[1])) for r in cases.ROWS
    )
    assert out.select("record.shard").distinct().collect()[0][0] == "shard"
    assert shuffle_to_shards(cases.none(spark)).count() == 0
    path = str(tmp_path / "shards")
    plain = shuffle_to_shards(cases.documents(spark), shards=4)
    write_shards(plain, path)
    back = spark.read.parquet(path)
    assert cases.rows_of(back.select("doc_id", "text", "shard", "slot")) == placed(plain)


def test_many_equal_rows_scatter_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(shuffling, "COPIES_PER_TASK", 1000)
    rows = [(1, "the same", "en", "a", 0)] * 20_000 + [(None, None, "en", f"s{i % 3}", 0) for i in range(3000)]
    rows += [(i, f"text {i}", "en", "a", 0) for i in range(500)]
    docs = cases.documents(spark, rows).repartition(8)
    keyed = docs.select(F.struct("*").alias("record")).withColumn("key", scatter_key(F.col("record"), 23))
    spread = scatter_copies(keyed)
    per_bucket = spread.groupBy(F.pmod("key", F.lit(30))).count()
    sizes = [r["count"] for r in per_bucket.collect()]
    assert len(sizes) == 30 and sum(sizes) == len(rows) and max(sizes) < 1.3 * len(rows) / 30
    out = shuffle_to_shards(docs, bucket_bytes=20_000)
    got = placed(out)
    assert sorted((r[:2] for r in got), key=repr) == sorted((r[:2] for r in rows), key=repr)
    per_shard = collections.defaultdict(list)
    for _, _, shard, slot in got:
        per_shard[shard].append(slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in per_shard.values())
    assert max(map(len, per_shard.values())) - min(map(len, per_shard.values())) <= 1
    assert placed(shuffle_to_shards(docs.repartition(3), bucket_bytes=20_000)) == got


def test_columns_of_the_query(spark, tmp_path):
    from tickloom.llm.queries import QUERIES

    cases.documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op4_shard_shuffle"](spark, str(tmp_path)).collect()
    want = sorted(
        ((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in cases.ROWS), key=repr
    )
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in out), key=repr) == want
    assert {(r["law"], r["grown_shard"]) for r in out} == {("rows", None)}
    assert len({(r["shard"], r["slot"]) for r in out}) == len(out) and {r["slot"] for r in out} == {0}
