from __future__ import annotations

import random

import cases
import xxhash
from pyspark.sql import functions as F

from tickloom.llm import simhash as module
from tickloom.llm.components import connected_components
from tickloom.llm.simhash import components, drop_near_duplicates, near_duplicates, simhash


def plain_simhash(text):
    own = cases.words(cases.ascii_lower(text))
    shingles = [" ".join(own[i : i + 3]) for i in range(len(own) - 2)] if len(own) >= 3 else [" ".join(own)] * bool(own)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: dict) -> dict:
    """Smallest key reachable over links of three bits or fewer."""
    keys = sorted(prints)
    root = {k: k for k in keys}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {k: top(k) for k in keys}


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def test_fingerprints(spark):
    for text in [r[1] for r in cases.ROWS] + ["One two", "ÄRGER Straße K\x0bx y", "a b c"]:
        assert simhash((text or "").encode()) == signed(plain_simhash(text))


def test_components_of_chains_and_crowds(spark, monkeypatch):
    monkeypatch.setattr(module, "TILE", 7)  # many tiles in a cell
    rng = random.Random(3)
    prints = {}
    for group in range(12):
        value = rng.getrandbits(64)
        for step in range(rng.randrange(1, 40)):
            prints[len(prints)] = value
            for bit in rng.sample(range(64), rng.randrange(0, 6)):
                value ^= 1 << bit
    centre = rng.getrandbits(64)
    for _ in range(150):  # a crowd around one fingerprint
        near = centre
        for bit in rng.sample(range(64), rng.randrange(0, 3)):
            near ^= 1 << bit
        prints[len(prints)] = near
    prints[len(prints)], prints[len(prints) + 1] = 0, 1
    df = spark.createDataFrame([(k, signed(v)) for k, v in prints.items()], "doc_id long, fp long")
    out = df.join(components(df), "fp").select("doc_id", "component_id").collect()
    assert {r[0]: r[1] for r in out} == groups(prints)


def test_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 499), (499, 499)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 499: 499, 500: 499}
    assert connected_components(links.limit(0)).count() == 0


def test_odd_rows(spark):
    docs = cases.documents(spark, clashing=True)
    out = cases.rows_of(near_duplicates(docs).select("doc_id", "component_id"))
    named = {i: r[1] for i, r in enumerate(cases.ROWS)}
    # null ids after all others
    by_row = groups({(r[0] if r[0] is not None else 10**9, i): plain_simhash(named[i]) for i, r in enumerate(cases.ROWS)})
    want = [(r[0], by_row[(r[0] if r[0] is not None else 10**9, i)][0]) for i, r in enumerate(cases.ROWS)]
    assert out == sorted(((a, None if b == 10**9 else b) for a, b in want), key=repr)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == sorted({repr(None if b == 10**9 else b) for _, b in want})
    assert near_duplicates(cases.none(spark)).count() == 0
    assert drop_near_duplicates(cases.none(spark)).count() == 0


def test_query_on_a_whole_table(spark):
    from tickloom.llm.queries import op10_simhash

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    prints = {r[0]: plain_simhash(r[1]) for r in docs}
    named = groups(prints)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op10_simhash(spark, folder).collect()}
    assert got == {k: (f"{v:016x}", named[k]) for k, v in prints.items()}


def test_spark_hash_is_the_same(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()
    assert row[0] == signed(xxhash.xxh64_intdigest(b"a b c", 42))


def test_documents_without_id_are_no_group(spark):
    texts = [" ".join(f"{name}{i}" for i in range(60)) for name in ("oak", "elm", "ash")]
    rows = [(None, text, "en", "a", 0) for text in [*texts, texts[0]]] + [(4, texts[2], "en", "a", 0)]
    kept = drop_near_duplicates(cases.documents(spark, rows))
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(
        [(None, texts[0]), (None, texts[1]), (4, texts[2])], key=repr
    )
