from __future__ import annotations

import collections
import hashlib

import cases
import pytest
from pyspark.sql import functions as F

from tickloom.llm import exact
from tickloom.llm.exact import POINTS, PRIMES, chunks, classes, exact_duplicates, fingerprints
from tickloom.session import materialise


def expected(rows):
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[cases.ascii_lower(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        top = max(ids, key=lambda i: (i is not None, i))
        first = True
        for doc_id in sorted(ids, key=repr):
            kept, first = doc_id == top and first, first and doc_id != top
            out.append((doc_id, top, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk", [7, 1 << 16])
def test_odd_rows(spark, chunk):
    rows = cases.ROWS + [(n, t, "en", "a", 0) for n, t in EXTRA]
    docs = cases.documents(spark, rows, clashing=True)
    assert cases.rows_of(exact_duplicates(docs, chunk)) == expected([r[:2] for r in rows])


EXTRA = [
    (20, "Größe É"),
    (21, "größe É"),
    (22, "größe é"),
    (23, "a\x00b"),
    (24, "A\x00B"),
    (25, "a\x00"),
    (26, "a"),
    (27, "x "),
]


def polynomial(data, point, prime):
    value = 0
    for code in data:
        value = (value * point + code) % prime
    return value


def test_chunks_compose_to_the_polynomial_of_the_whole(spark):
    texts = ["", "a", "Abc" * 50, "é" * 77, "z" * 1000]
    docs = cases.documents(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)])
    for chunk in (1, 333):
        rows = fingerprints(materialise(chunks(docs, chunk), "chunks"), chunk).collect()
        got = {r["doc_id"]: (r["n_bytes"], r["h1"], r["h2"]) for r in rows}
        for i, text in enumerate(texts):
            data = cases.ascii_lower(text).encode()
            hashes = [polynomial(data, x, p) for x, p in zip(POINTS, PRIMES)]
            assert got[i] == (len(data), *hashes)


def test_equal_fingerprints_of_different_texts(spark, monkeypatch):
    monkeypatch.setattr(exact, "SALTED", 2)
    texts = ["aa", "ab", "aa", "ac", "ab", "aa", "aa", "b"] * 2
    docs = cases.documents(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)])
    cut = materialise(chunks(docs, 1), "chunks")
    signed = fingerprints(cut, 1).withColumns({"h1": F.lit(1), "h2": F.lit(1)})
    signed = materialise(signed, "signed")
    named = classes(signed, cut).join(signed.select("row", "doc_id"), "row").collect()
    by_class = collections.defaultdict(set)
    for r in named:
        by_class[r["class"]].add(texts[r["doc_id"]])
    assert len(named) == len(texts)
    assert sorted(map(sorted, by_class.values())) == [["aa"], ["ab"], ["ac"], ["b"]]


def test_many_copies_are_dealt_over_salts(spark, monkeypatch):
    monkeypatch.setattr(exact, "SALTED", 10)
    rows = [(i, "the same text" if i % 3 else f"text {i}", "en", "a", 0) for i in range(300)]
    out = exact_duplicates(cases.documents(spark, rows)).where("group_size > 1")
    assert out.agg(F.count("*"), F.min("keep_id"), F.sum(F.col("kept").cast("int"))).first() == (200, 299, 1)


def test_long_text_and_empty_table(spark):
    long = "Wort und Satz\n" * 30_000
    docs = cases.documents(spark, [(1, long, "de", "a", 0), (2, long.upper(), "de", "a", 0), (3, long[:-1], "de", "a", 0)])
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_duplicates(docs).collect()}
    assert got == {1: (2, 2), 2: (2, 2), 3: (3, 1)}
    assert exact_duplicates(cases.none(spark)).count() == 0
