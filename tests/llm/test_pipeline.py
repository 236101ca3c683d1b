from __future__ import annotations

import collections

import cases
import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F

from tickloom.llm.lines import dedup_lines
from tickloom.llm.mixing import SEED, count_words, mix_sized, seeded
from tickloom.llm.simhash import near_duplicates
from tickloom.session import materialise

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        docs = materialise(stage(spark, docs, FOLDER), "test")
        out.append(docs)
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_every_stage_acts_on_what_the_one_before_kept(spark, tables):
    raw, good, lines, single, mixed, packed = tables
    for table in tables[:-1]:
        assert table.columns == pipeline.COLUMNS
    assert ids(good) < ids(raw)
    kept = cases.rows_of(dedup_lines(good).select("doc_id", "lines.kept"))
    assert cases.rows_of(lines.select("doc_id", "text")) == kept
    groups = near_duplicates(lines)
    assert ids(single) == {r[0] for r in groups.select("component_id").distinct().collect()}
    sized = single.select(
        "doc_id",
        "source",
        count_words(F.col("text")).alias("size"),
        seeded(F.col("doc_id"), SEED).alias("place"),
        F.xxhash64("text").alias("tie"),
    )
    want = {r["doc_id"]: r["taken"] for r in mix_sized(sized).collect() if r["taken"]}
    taken = collections.Counter()
    for r in mixed.collect():
        taken[r["doc_id"]] += len(cases.words(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert taken == want
    starts = packed.where("start = 0").groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in starts} == {
        r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()
    }


def test_good_documents_pass_the_rules(spark, tables):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    good = ids(labels.where("quality = 1")) & ids(tables[0])
    long_enough = {r["doc_id"] for r in tables[0].collect() if len(cases.words(r["text"])) >= 20}
    assert good & long_enough <= ids(tables[1])
    bad = ids(labels.where("quality = 0")) & ids(tables[0])
    assert len(bad & ids(tables[1])) <= 0.2 * len(bad)


def test_odd_rows_go_through(spark):
    docs = cases.documents(spark, clashing=True)
    for _, stage in pipeline.STAGES:
        docs = materialise(stage(spark, docs, FOLDER), "test")
    empty = cases.none(spark)
    for _, stage in pipeline.STAGES:
        empty = materialise(stage(spark, empty, FOLDER), "test")
    assert empty.count() == 0
