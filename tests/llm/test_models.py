"""Both classifiers: held-out accuracy, what they learn from, and odd rows."""

from __future__ import annotations

import collections
import random
import re
import unicodedata
import zlib

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import toxicity
from tickloom.llm.quality_model import isotonic, score_quality
from tickloom.llm.toxicity import passage_scores, score_toxicity

PLAIN = [f"word{i}" for i in range(400)]
BAD = ["grobian", "grobling", "grobster", "shmuckle", "shmuckest"]


def corpus(spark, toxic_every=5, n=500, labelled=lambda i: True):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        own = rng.choices(PLAIN, k=rng.randrange(20, 400))
        toxic = i % toxic_every == 0
        junk = i % 7 == 0
        if toxic:
            for at in rng.sample(range(len(own)), 3):
                own[at] = rng.choice(BAD)
        text = " ".join(f"{w.upper()}!!" if junk else w for w in own)
        rows.append((i, text, "en", "a", 0))
        if labelled(i):
            labels.append((i, int(not junk), int(toxic)))
    return cases.documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def accuracy(scored, truth, held_out):
    rows = [r for r in scored.collect() if r["held_out"] == held_out]
    return sum((r["score"] >= 0.3) == truth(r["doc_id"]) for r in rows) / len(rows)


def test_toxic_words_and_their_kin_are_found(spark):
    docs, labels = corpus(spark)
    scored = score_toxicity(docs, labels)
    assert accuracy(scored, lambda i: i % 5 == 0, True) >= 0.97
    folds = {r["doc_id"]: r["held_out"] for r in scored.collect()}
    assert folds == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(500)}
    # a word never seen is judged by its stem
    new = cases.documents(spark, [(1000, "word1 word2 grobissimo word3 grobianic " * 2, "en", "a", 0)])
    assert score_toxicity(docs.unionByName(new), labels).where("doc_id = 1000").first()["score"] > 0.3


@pytest.mark.parametrize("share, longs", [(0.01, 1 << 21), (1.0, 1 << 21), (0.01, 1)])
def test_entries_that_are_not_sent_count_as_well(spark, monkeypatch, share, longs):
    docs, labels = corpus(spark)
    want = {r["doc_id"]: r["score"] for r in score_toxicity(docs, labels).collect()}
    monkeypatch.setattr(toxicity, "MIN_SHARE", share)
    monkeypatch.setattr(toxicity, "FILTER_LONGS", longs, raising=False)
    got = score_toxicity(docs, labels)
    assert {r["doc_id"]: r["score"] for r in got.collect()} == pytest.approx(want, abs=1e-9)
    assert accuracy(got, lambda i: i % 5 == 0, True) >= 0.97


def test_words_count_after_the_word_before(spark, monkeypatch):
    # each word as often in either class; only in toxic texts do they come in this order
    monkeypatch.setattr(toxicity, "PAIR_BACKOFF", 1000.0)  # for a corpus a twentieth of sf0.1
    rng = random.Random(2)
    plain = [a + b + c for a in "bcdfghj" for b in "aeiou" for c in "klmnpqrst"]
    rows, labels = [], []
    for i in range(400):
        own, toxic = rng.choices(plain, k=60), i % 4 == 0
        for at in rng.sample(range(1, 60, 3), 12):
            own[at - 1 : at + 1] = ("go", "home") if toxic else ("home", "go")
        rows.append((i, " ".join(own), "en", "a", 0))
        labels.append((i, 1, int(toxic)))
    docs = cases.documents(spark, rows)
    scored = score_toxicity(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert accuracy(scored, lambda i: i % 4 == 0, True) >= 0.97


def test_ratios_equal_a_recount(spark):
    docs, labels = corpus(spark, n=120)
    texts = {r["doc_id"]: r["text"].lower() for r in docs.collect()}
    known = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    told = toxicity.with_label(docs, toxicity.label_of(labels, "toxic"))
    rows = toxicity.continuation_counts(toxicity.word_counts(told)).collect()
    pairs = {}
    for i, text in texts.items():
        own = re.findall("[a-z]+", text)
        for pair in zip([None, *own], own):
            pairs.setdefault(pair, []).append(known[i])
    words = {w for _, w in pairs}
    n = lambda w: sum(len(v) for (_, x), v in pairs.items() if x == w)
    after = lambda w, c: sum(c in v for (_, x), v in pairs.items() if x == w)
    assert sorted((r["n"], r["c_toxic"], r["c_plain"]) for r in rows if r["kind"] == "word") == sorted(
        (n(w), after(w, 1), after(w, 0)) for w in words
    )
    frequent = [v for v in pairs.values() if len(v) >= toxicity.MIN_COUNT]
    assert sorted((r["n"], r["toxic"]) for r in rows if r["kind"] == "pair") == sorted((len(v), sum(v)) for v in frequent)


def test_equal_texts_score_alike_beside_each_other(spark):
    docs, labels = corpus(spark)
    same = ["grobian", "grobian word1 word2 grobian", "grobian word1 grobian grobian"]
    rows = [(1000 + 10 * k + i, text, "en", "a", 0) for k, text in enumerate(same) for i in range(10)]
    scored = score_toxicity(docs.unionByName(cases.documents(spark, rows).coalesce(1)), labels)
    raw = {r["doc_id"]: r["raw"] for r in scored.where("doc_id >= 1000").collect()}
    one, two, three = ({raw[1000 + 10 * k + i] for i in range(10)} for k in range(3))
    assert len(one) == len(two) == len(three) == 1 and two == three and min(one) > 0


def test_quality_is_learned(spark):
    docs, labels = corpus(spark)
    scored = score_quality(docs, labels)
    assert accuracy(scored, lambda i: i % 7 != 0, True) >= 0.97
    folds = {r["doc_id"]: r["held_out"] for r in scored.collect()}
    assert folds == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(500)}


@pytest.mark.parametrize("score, folds, held", [(score_toxicity, 4, 2), (score_quality, 5, 0)])
def test_held_out_labels_are_never_seen(spark, score, folds, held):
    docs, labels = corpus(spark, n=120)
    flipped = labels.selectExpr(
        "doc_id",
        f"IF(crc32(CAST(doc_id AS STRING)) % {folds} = {held}, 1 - quality, quality) AS quality",
        f"IF(crc32(CAST(doc_id AS STRING)) % {folds} = {held}, 1 - toxic, toxic) AS toxic",
    )
    one, two = ({r["doc_id"]: r["score"] for r in score(docs, x).collect()} for x in (labels, flipped))
    assert one == pytest.approx(two, abs=1e-9)


@pytest.mark.parametrize("score", [score_toxicity, score_quality])
def test_odd_rows(spark, score):
    docs = cases.documents(spark, clashing=True)
    odd = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 0), (2, 0, 1), (5, None, None), (6, 1, 0), (7, 0, 1), (8, 1, 0), (None, 0, 1), (9, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    rows = score(docs, odd).collect()
    assert len(rows) == len(cases.ROWS)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert not [r for r in rows if r["doc_id"] is None and r["held_out"]]
    assert score(cases.none(spark), odd).count() == 0
    unlabelled = score(docs, odd.limit(0)).collect()
    assert {r["score"] for r in unlabelled} == ({0.5} if score is score_quality else {0.0})
    one_class = score(docs, odd.selectExpr("doc_id", "1 AS quality", "1 AS toxic")).collect()
    assert all(r["score"] >= 0.99 for r in one_class)


def test_passages_cover_the_whole_text():
    rng = np.random.default_rng(3)
    sizes = [0, 1, 63, 64, 65, 0, 500, 64]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    ratios = rng.normal(0, 3, offsets[-1]).astype(np.float32)
    strong = ratios - np.clip(ratios, -toxicity.MILD, toxicity.MILD)
    want = []
    for a, b in zip(offsets, offsets[1:]):
        own = strong[a:b]
        runs = [own[i : i + 64].sum() / 64 for i in range(max(1, len(own) - 63))]
        want.append(max(runs))
    assert passage_scores(ratios, offsets, 64) == pytest.approx(want, abs=1e-5)


def test_short_texts_score_the_mean_of_their_own_words(spark):
    offsets = np.array([0, 0, 1, 21, 84, 148, 213])
    ratios = np.random.default_rng(5).normal(0, 3, offsets[-1]).astype(np.float32)
    strong = ratios - np.clip(ratios, -toxicity.MILD, toxicity.MILD)
    want = [0.0] + [strong[a:b].mean() for a, b in zip(offsets[1:5], offsets[2:6])]
    assert passage_scores(ratios, offsets, 64, least=1)[:5] == pytest.approx(want, abs=1e-5)
    docs, labels = corpus(spark)
    new = cases.documents(spark, [(1000, "shmuckle word1", "en", "a", 0), (1001, "shmuckle word1 word2 word3", "en", "a", 0)])
    scored = score_toxicity(docs.unionByName(new), labels).where("doc_id >= 1000")
    raw = {r["doc_id"]: r["raw"] for r in scored.collect()}
    assert raw[1000] == pytest.approx(2 * raw[1001]) and raw[1001] > 0.1


def test_isotonic_levels_never_fall():
    at, level = isotonic(np.array([0.0, 1, 2, 3]), np.array([2, 2, 2, 4]), np.array([1, 0, 2, 4]))
    assert at.tolist() == [0.5, 2 + 2 / 3] and level.tolist() == [0.25, 1.0]


def described(text):
    """The statistics of a text, counted without Spark."""
    n = max(len(text), 1)
    own = cases.words(text)
    k = max(len(own), 1)
    lines = text.split("\n")
    share = lambda kept: sum(map(kept, text)) / n
    return [
        np.log1p(len(text)),
        share(lambda c: unicodedata.category(c) == "Lu"),
        *[share(lambda c, some=some: c in some) for some in ("#*$%&<>", "|", "!?", ".,;:", "0123456789", " \t\n\x0b\x0c\r")],
        np.log1p(len(own)),
        len("".join(own)) / k / 10,
        len(set(own)) / k,
        sum(a == b for a, b in zip(own, own[1:])) / k,
        np.log1p(len(lines)),
        len(set(lines)) / len(lines),
    ]


def test_quality_equals_a_fit_over_all_rows_at_once(spark):
    docs, labels = corpus(spark, n=300, labelled=lambda i: i % 4)
    got = {r["doc_id"]: r for r in score_quality(docs, labels).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    learned = [i for i in sorted(known) if zlib.crc32(str(i).encode()) % 5]
    x = {i: np.array(described(t)) for i, t in texts.items()}
    rows = np.stack([x[i] for i in learned])
    y = np.array([known[i] for i in learned], dtype=float)
    mean, scale = rows.mean(0), rows.std(0)
    scale[scale <= 1e-9] = 1
    rng = np.random.default_rng(31)
    w, b = rng.normal(size=(rows.shape[1], 256)) / 3, rng.uniform(0, 2 * np.pi, 256)
    phi = lambda r: np.append(np.sqrt(2 / 256) * np.cos(np.clip((r - mean) / scale, -8, 8) @ w + b), 1)
    design = np.stack([phi(r) for r in rows])
    # ridge as least squares with penalty rows
    tall = np.vstack([design, np.sqrt(1e-3 * len(y)) * np.eye(257)])
    beta = np.linalg.lstsq(tall, np.append(y, np.zeros(257)), rcond=None)[0]
    raw = {i: float(phi(x[i]) @ beta) for i in x}
    for i, value in raw.items():
        assert got[i]["raw"] == pytest.approx(value, abs=1e-6)
    step = 2 / 1024
    # the calibration is recounted from the scores themselves, so that rounding moves no row to another bin
    at = np.clip(np.floor((np.array([got[i]["raw"] for i in learned]) + 0.5) / step), 0, 1023)
    bins = np.unique(at)
    n, hits = (np.array([v[at == c].sum() for c in bins]) for v in (np.ones(len(y)), y))
    means = lambda a, c: hits[a : c + 1].sum() / n[a : c + 1].sum()
    level = [max(min(means(a, c) for c in range(i, len(bins))) for a in range(i + 1)) for i in range(len(bins))]
    pools = [np.flatnonzero(np.isclose(level, v, rtol=0, atol=1e-12)) for v in dict.fromkeys(np.round(level, 12))]
    centres = [((-0.5 + (bins[p] + 0.5) * step) * n[p]).sum() / n[p].sum() for p in pools]
    levels = [level[p[0]] for p in pools]
    for i in x:
        assert got[i]["score"] == pytest.approx(float(np.interp(got[i]["raw"], centres, levels)), abs=1e-9)


def test_plain_texts_meet_their_labels_where_they_lie(spark):
    docs, labels = corpus(spark, n=200, labelled=lambda i: i % 3 != 0)
    odd = [(700, "grobian und mehr", "en", "a", 0), (700, "zwei", "en", "a", 0), (701, None, "en", "a", 0)]
    texts = docs.unionByName(cases.documents(spark, odd)).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    more = spark.createDataFrame([(700, 1, 0), (700, 1, 1), (701, 1, 0), (701, 1, 0)], labels.schema)
    known = toxicity.label_of(labels.unionByName(more), "toxic")
    rows = toxicity.learning_rows(texts, known)
    want = toxicity.with_label(texts, known).collect()
    told = collections.Counter((r["text"], r["label"] >= 0.5) for r in rows.collect())
    assert told == collections.Counter((r["text"], r["label"] >= 0.5) for r in want)
    # only texts that may be toxic are shuffled
    plan = rows.select("text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and sum(r["label"] < 0.5 for r in want) > 60
    before = toxicity.before_counts(toxicity.continuation_counts(toxicity.word_counts(rows)))
    pairs = collections.Counter()
    for r in want:
        own = re.findall(r"[^\W\d_]+", r["text"].lower())
        pairs.update((b, w) for b, w in zip([None, *own], own))
    frequent = {b for (b, _), n in pairs.items() if n >= toxicity.MIN_COUNT}
    n = collections.Counter()
    for (b, _), k in pairs.items():
        n[b] += k
    assert sorted(r["n"] for r in before.collect()) == sorted(n[b] for b in frequent)


def test_pairs_are_counted_before_they_are_shuffled(spark):
    learning = spark.createDataFrame([("go home now " * 300, 1.0)] * 40, "text string, label double").coalesce(2)
    counts = toxicity.word_counts(learning)
    assert sorted(r["n"] for r in counts.where(F.col("word") != toxicity.END).collect()) == [40, 11960, 12000, 12000]
    words = counts.groupBy("word", "stem").count()._jdf.queryExecution().executedPlan().toString()
    assert words.count("Exchange hashpartitioning") == 1  # a word's pairs meet at once
    tables = toxicity.continuation_counts(counts)
    assert sorted(r["kind"] for r in tables.collect()) == ["last", *["pair"] * 4, "texts", *["word"] * 3]
    assert "ReusedExchange" in tables._jdf.queryExecution().executedPlan().toString()
