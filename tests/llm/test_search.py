from __future__ import annotations

import collections
import math
import re

import cases
import numpy as np

from tickloom.llm import search as module
from tickloom.llm.search import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(cases.ascii_lower(text))


def brute(items, docs, k=10):
    counted = [(i, collections.Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = collections.Counter(t for _, c in counted for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        asked = collections.Counter(terms(text))
        scored = []
        for doc_id, c in counted:
            m = 25 + 75 * sum(c.values()) * n_docs // total
            score = 0
            for t, repeats in asked.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += repeats * w * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k]):
            out.append((item, rank + 1, doc_id, -score))
    return sorted(out, key=repr)


ITEMS = [
    (1, "The cat and the big red barn"),
    (1, "The cat and the big red barn"),
    (1, "an other text of the same id: shared line"),
    (2, "MIT license, étude k Ärger"),
    (3, None),
    (4, "... --- ..."),
    (5, "nowhere found"),
    (None, "word7 of the part7 word8 word8 word8"),
]


def table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS rank", "2 AS doc_id")


def test_odd_rows(spark):
    docs = cases.documents(spark, clashing=True).repartition(3)
    got = cases.rows_of(search(table(spark, ITEMS), docs))
    assert got == brute(ITEMS, [r[:2] for r in cases.ROWS])
    assert search(table(spark, ITEMS), cases.none(spark)).count() == 0
    assert search(table(spark, []), docs).count() == 0


def many(n):
    rng = np.random.default_rng(11)
    text = lambda: " ".join(f"w{int(z)}" for z in rng.zipf(1.4, rng.integers(1, 40)))
    return [(int(i), text()) for i in rng.permutation(n)]


def test_ties_blocks_and_strips(spark, monkeypatch):
    """Many equal scores, more items than a block holds, and strips of few documents."""
    monkeypatch.setattr(module, "CELLS", 64)
    monkeypatch.setattr(module, "PAIRS", 50)
    rows = many(150)
    rows += [(i + 1000, t) for i, t in rows]
    items = many(20) + [(99, "w1"), (98, "w2 w2 w1")]
    docs = cases.documents(spark, [(*r, "en", "a", 0) for r in rows]).repartition(5)
    want = brute(items, rows)
    assert cases.rows_of(search(table(spark, items), docs)) == want
    assert cases.rows_of(search(table(spark, items), docs, block_terms=100)) == want
    assert cases.rows_of(search(table(spark, items), docs, k=3)) == [r for r in want if r[1] <= 3]


def test_query_on_a_whole_table(spark):
    from tickloom.llm.queries import op11_lexical_search

    folder = "/root/testdata/sf0.001"
    read = lambda name: [tuple(r) for r in spark.read.parquet(f"{folder}/{name}.parquet").collect()]
    docs = [r[:2] for r in read("documents")]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    assert cases.rows_of(op11_lexical_search(spark, folder)) == brute(items, docs)
