from __future__ import annotations

import collections

import cases
import pytest
from pyspark.sql import functions as F

from tickloom.llm.mixing import (
    SEED, apportion, count_words, in_shards, mix_sized, mix_texts, seeded, spread_places, targets,
)


def sized(docs):
    return docs.select(
        "doc_id",
        "source",
        count_words(F.col("text")).alias("size"),
        seeded(F.col("doc_id"), SEED).alias("place"),
        F.xxhash64("text").alias("tie"),
    )


def seats_by_quotient(weights, seats, caps):
    won = [0] * len(weights)
    for _ in range(seats):
        open_ = [i for i in range(len(weights)) if won[i] < caps[i]]
        if not open_:
            break
        best = max(open_, key=lambda i: (weights[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


@pytest.mark.parametrize(
    "weights, seats, caps",
    [
        ([53, 24, 23], 10, [99] * 3),
        ([1000, 1, 1, 1, 1, 1], 7, [99] * 6),
        ([7] * 9, 13, [99] * 9),
        ([5, 4, 3, 2, 1], 40, [12, 99, 99, 99, 99]),
        ([3, 0, 2], 4, [9, 0, 9]),
        ([10, 10], 0, [9, 9]),
    ],
)
def test_quotas_go_by_highest_quotients(spark, weights, seats, caps):
    rows = [("g", i, w, sum(weights), seats, c) for i, (w, c) in enumerate(zip(weights, caps))]
    df = spark.createDataFrame(rows, "g string, i int, w long, total long, seats long, cap long")
    out = apportion(df, ["g"], ["i"], "w", "total", "seats", "cap").orderBy("i")
    assert [r["quota"] for r in out.collect()] == seats_by_quotient(weights, seats, caps)


def test_targets_stop_at_the_cap(spark):
    # weights 5, 2, 1, 5: the small source stops at 3 times its size, the rest is shared 2 : 1 : 5
    rows = [("a", 10), ("b", 400), ("c", 300), (None, 290)]
    out = targets(spark.createDataFrame(rows, "source string, size long"), (5, 2, 1), 3)
    got = {r["source"]: r["target"] for r in out.collect()}
    rest = 1000 - 30
    want = {"a": 30.0, "b": rest * 2 / 8, "c": rest / 8, None: rest * 5 / 8}
    assert got == pytest.approx(want)


def test_taken_words_come_near_their_target(spark):
    rows = [
        (i, " ".join(["w"] * (1 + i * 37 % 90)), "en", f"s{i * i % 7}" if i % 3 else "hot", 0) for i in range(600)
    ]
    out = mix_sized(sized(cases.documents(spark, rows))).collect()
    taken, goal = collections.Counter(), {}
    for r in out:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        goal[r["source"]] = r["target"]
    assert len(out) == 600
    for source, target in goal.items():
        assert abs(taken[source] - target) <= max(0.02 * target, 24)


def test_odd_rows_rerun_and_texts(spark):
    docs = cases.documents(spark, clashing=True)
    first = cases.rows_of(mix_sized(sized(docs)).select("doc_id", "size", "target", "taken"))
    again = cases.rows_of(mix_sized(sized(docs.repartition(3))).select("doc_id", "size", "target", "taken"))
    assert first == again and len(first) == len(cases.ROWS)
    mixed = mix_texts(docs)
    assert mixed.columns == docs.columns
    per_id = collections.Counter()
    for r in mixed.collect():
        assert r["n_chars"] == len(r["text"]) and r["size"] == "size"
        per_id[r["doc_id"]] += len(cases.words(r["text"]))
    want = collections.Counter()
    for doc_id, _, _, taken in first:
        want[doc_id] += taken
    assert +per_id == +want


def test_rows_without_id_and_equal_rows_spread_over_shards(spark):
    rows = [(None, f"w {i} " * (1 + i % 5), "en", "hot", 0) for i in range(2000)]
    rows += [(7, "the same five words again", "en", "hot", 0)] * 3000
    rows += [(i, "w " * (i % 50), "en", f"s{i % 3}", 0) for i in range(500)]
    docs = cases.documents(spark, rows)
    spread = spread_places(sized(docs))
    assert spread.count() == len(rows)
    sources = spread.groupBy("source").agg(F.count("*").alias("documents"))
    shards = in_shards(spread, sources).where("source = 'hot'").groupBy("shard").count().collect()
    assert len(shards) == 71 and max(r["count"] for r in shards) < 2 * 5000 / 71
    columns = ["doc_id", "source", "size", "target", "taken"]
    first = cases.rows_of(mix_sized(sized(docs)).select(*columns))
    assert first == cases.rows_of(mix_sized(sized(docs.repartition(5))).select(*columns))
    taken, goal = collections.Counter(), {}
    for _, source, size, target, own in first:
        assert 0 <= own <= 3 * size
        taken[source] += own
        goal[source] = target
    assert len(first) == len(rows)
    assert all(abs(taken[s] - goal[s]) <= max(0.02 * goal[s], 24) for s in goal)


def test_tables_without_words(spark):
    assert mix_texts(cases.none(spark)).count() == 0
    blank = cases.documents(spark, [(1, None, "en", "a", 0), (2, " ", "en", None, 1)])
    assert [r["taken"] for r in mix_sized(sized(blank)).collect()] == [0, 0]
    assert mix_texts(blank).count() == 0
