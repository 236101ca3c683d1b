from __future__ import annotations

import base64
import hashlib
import re

import cases
import pytest
import xxhash
from pyspark.sql import functions as F

from tickloom.llm import spotsigs
from tickloom.llm.spotsigs import COMMON_WORDS, edited, fingerprint, following, signatures, similar_pairs


def chains(text):
    """Signature chains as words, not hashes."""
    own = re.findall(r"[^\W_]+", text.lower())
    out = set()
    for i, w in enumerate(own[:-1]):
        if w in COMMON_WORDS and own[i + 1] not in COMMON_WORDS:
            content = [x for x in own[i + 1 : i + 60] if x not in COMMON_WORDS][:2]
            if len(content) == 2:
                out.add((w, *content))
    return out


def hash_of(*words):
    seed = 42
    for word in words:
        seed = xxhash.xxh64_intdigest(word.encode(), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def signature_rows(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r[0] for r in df.orderBy("i").select(signatures(F.col("text"))).collect()]


def test_signatures_are_chains_behind_common_words(spark):
    texts = [cases.ROWS[0][1], cases.LONG, "The old man of the sea", "the", "of the of big house red", "Über die Brücke der Stadt Wien"]
    for text, got in zip(texts, signature_rows(spark, texts)):
        want = sorted(hash_of(*c) for c in chains(text))
        own = re.findall(r"[^\W_]+", text.lower())
        assert got == (want or [hash_of(" ".join(own))])


def test_texts_without_chains(spark):
    a, b, c, d = signature_rows(spark, ["", " . ", "one two", "One, two!"])
    assert a == [hash_of("")] and b == [hash_of(" . ")] and c == d == [hash_of("one two")]


def test_texts_without_common_words_differ_by_degrees(spark):
    plain = [f"слово{i}" for i in range(60)]
    changed = [*plain[:45], "иное", *plain[46:]]
    mixed = ["the", *plain]
    rows = [" ".join(w) for w in (plain, changed, mixed, ["the", *changed], plain[:4])]
    a, b, c, d, e = signature_rows(spark, rows)
    runs = lambda own: sorted(hash_of(*own[i : i + 3]) for i in range(len(own) - 2))
    assert (a, b, e) == (runs(plain), runs(changed), runs(plain[:4]))
    assert len(set(a) & set(b)) == 55
    # one chain behind the common word, then those of the long run without one
    assert c == sorted([hash_of("the", *plain[:2]), *runs(plain[32:])])
    assert len(set(c) & set(d)) == len(c) - 3


@pytest.mark.parametrize("cell_rows", [2, 3, 4096])
def test_edits_use_the_following_document(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(spotsigs, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(spotsigs, "BOUND_IDS", 12)  # bounds from a sample of the ids
    rows = [(i * i - 40, f"The number {i} of a list and the house {i * 7} in red " * (i % 4), "en", "a", 0) for i in range(23)]
    rows += [(10**15, "a last one of the rows with some words", "en", "a", 0), (7, None, "en", "a", 0)]
    docs = cases.documents(spark, rows, clashing=True)
    got = following(docs).select("doc_id", edited(F.col("text"), F.col("next_text")))
    order = sorted((r[0], r[1] or "") for r in rows)
    want = []
    for k, (doc_id, text) in enumerate(order):
        half = len(text) // 2
        want.append((doc_id, text[: len(text) - half] + order[(k + 1) % len(order)][1][:half]))
    assert cases.rows_of(got) == sorted(want, key=repr)


def test_ties_nulls_one_row_and_no_row(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "CELL_ROWS", 2)
    nulls = [(None, f"text {i} of the null ids", "en", "a", 0) for i in range(40)]
    docs = cases.documents(spark, [*cases.ROWS, *nulls])
    out = following(docs)
    assert out.count() == len(cases.ROWS) + 40
    # every row is followed by one and follows one
    texts = lambda c: sorted((r[0] for r in out.select(c).collect()), key=repr)
    assert texts("text") == texts("next_text")
    assert following(cases.none(spark)).count() == 0
    (one,) = following(cases.documents(spark, cases.ROWS[:1])).collect()
    assert one["next_text"] == one["text"] and one["next_sigs"] == one["sigs"]


def test_fingerprint_holds_all_signatures(spark):
    df = spark.createDataFrame([(cases.LONG,), ("x",)], "text string").withColumn("s", signatures(F.col("text")))
    for row in df.select("s", fingerprint(F.col("s")).alias("f")).collect():
        data = base64.b64decode(row["f"])
        numbers = [int.from_bytes(data[i : i + 8], "big", signed=True) for i in range(0, len(data), 8)]
        assert numbers == row["s"]


def test_similar_pairs_are_all_found(spark):
    import random

    rng = random.Random(4)
    base = [[f"w{rng.randrange(9999)}" for _ in range(80)] for _ in range(8)]
    rows, i = [], 0
    for words in base:
        for changes in (0, 0, 1, 2, 5, 20):
            own = list(words)
            for at in rng.sample(range(80), changes):
                own[at] = f"n{rng.randrange(10**6)}"
            rows.append((i, " the ".join(own), "en", "a", 0))
            i += 1
    docs = cases.documents(spark, [*rows, (900, None, None, None, None), (901, "", None, None, None)])
    members, pairs = similar_pairs(docs)
    named = {r["doc_id"]: r["class_id"] for r in members.collect()}
    assert named[900] == named[901] == 900 and named[1] == 0
    sets = {r[0]: chains(r[1]) for r in rows if named[r[0]] == r[0]}
    want = {
        (a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        for a in sets
        for b in sets
        if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    }
    assert {(r[0], r[1]): r[2] for r in pairs.collect()} == pytest.approx(want) and len(want) > 8


def test_query_on_a_whole_table(spark):
    from tickloom.llm.queries import op1_spot_signatures

    folder = "/root/testdata/sf0.001"
    texts = {r[0]: r[1] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    order = sorted(texts)
    rows = op1_spot_signatures(spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == order
    prints = {r["doc_id"]: set(base64.b64decode(r["fingerprint"])[i : i + 8] for i in range(0, len(base64.b64decode(r["fingerprint"])), 8)) for r in rows}
    for r in rows:
        text = texts[r["doc_id"]]
        after = order[(order.index(r["doc_id"]) + 1) % len(order)]
        half = len(text) // 2
        changed = text[: len(text) - half] + texts[after][:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        a, b = prints[r["doc_id"]], prints[after]
        assert r["near_next"] == pytest.approx(len(a & b) / len(a | b))
        assert 0 <= r["near_edited"] <= 1
