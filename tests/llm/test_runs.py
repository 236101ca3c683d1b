from __future__ import annotations

import random
import zlib

import cases
import numpy as np
from pyspark.sql import functions as F

from tickloom.llm.common import text_of, words_of
from tickloom.llm.runs import find_runs, periodic_runs, successors


def stretches(words, q):
    """Longest stretches in which words q apart are equal."""
    start = None
    for i in range(len(words) - q + 1):
        same = i < len(words) - q and words[i] == words[i + q]
        if same and start is None:
            start = i
        if not same and start is not None:
            yield start, i + q - start
            start = None


def brute(words):
    out = []
    for q in range(1, len(words) // 4 + 1):
        for start, length in stretches(words, q):
            own = words[start : start + length]
            if length >= max(6, 4 * q) and all(own[p:] != own[:-p] for p in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(texts):
    words = np.array([w for t in texts for w in t], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    out = [[] for _ in texts]
    for text, *run in find_runs(words, offsets):
        out[text].append(tuple(run))
    return out


def some_texts(rng, n, letters, longest):
    for _ in range(n):
        text = []
        while len(text) < longest and rng.random() < 0.9:
            root = [rng.randrange(letters) for _ in range(rng.choice((1, 1, 2, 3, 5, 8, 9, 17)))]
            text += root * rng.randrange(1, 9) + root[: rng.randrange(len(root))]
            text += [rng.randrange(letters) for _ in range(rng.randrange(4))]
        yield text


def test_all_runs_of_texts_with_nested_repeats():
    rng = random.Random(5)
    for letters in (1, 2, 3, 50):
        texts = list(some_texts(rng, 60, letters, 150))
        assert found(texts) == [brute(t) for t in texts]


def test_equal_texts_side_by_side_do_not_run_on():
    texts = [[1, 2, 3], [1, 2, 3], [1, 2, 3], [1, 2, 3], [], [1, 2, 3] * 4, [7] * 5, [7] * 6]
    assert found(texts) == [[], [], [], [], [], [(0, 12, 3)], [], [(0, 6, 1)]]


def test_every_period_at_every_place():
    for q in range(1, 40):
        for at in range(9):
            text = [1000 + i for i in range(at)] + list(range(q)) * 4 + [1999] * (q > 1)
            text += list(range(0)) if q > 1 else [0, 0]
            assert found([text])[0] == [(at, 4 * q if q > 1 else 6, q)], (q, at)


def test_successor_of_a_place():
    rng = np.random.default_rng(3)
    values = rng.permutation(200)
    low = rng.integers(0, 200, 500)
    high = np.minimum(low + rng.integers(0, 60, 500), 200)
    least = rng.integers(0, 210, 500)
    want = [min([v for v in values[a:b] if v >= x], default=-1) for a, b, x in zip(low, high, least)]
    assert successors(values, low, high, least).tolist() == want


def fast(words):
    """Brute force by numpy, for whole documents."""
    ids = np.unique(words, return_inverse=True)[1] if words else np.empty(0, dtype=int)
    out = []
    for q in range(1, len(ids) // 4 + 1):
        same = np.concatenate([[0], (ids[:-q] == ids[q:]).astype(np.int8), [0]])
        change = np.flatnonzero(np.diff(same))
        for start, stop in zip(change[::2].tolist(), change[1::2].tolist()):
            length = stop - start + q
            if length >= max(6, 4 * q):
                own = ids[start : start + length]
                if all(not np.array_equal(own[p:], own[:-p]) for p in range(1, q) if q % p == 0):
                    out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def checked(df):
    """Runs and kept words of each row, compared with brute force; the number of rows."""
    rows = df.collect()
    for r in rows:
        words, runs = r["words"], [tuple(run) for run in r["runs"]]
        assert runs == fast(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert r["kept"] == [w for i, w in enumerate(words) if i not in gone]
    return len(rows)


def test_odd_rows_and_clashing_columns(spark):
    rows = [r for r in cases.ROWS if r[1] != cases.LONG]
    docs = cases.documents(spark, rows, clashing=True).withColumn("runs", F.lit(1)).withColumn("a b:c", F.lit(2))
    out = periodic_runs(docs.withColumn("own words", words_of(text_of())), "own words", batch_words=50)
    assert checked(out) == len(rows)
    assert out.select("row.`a b:c`", "row.runs").distinct().collect() == [(2, 1)]
    assert periodic_runs(cases.none(spark).withColumn("words", words_of(F.col("text")))).count() == 0


def test_very_long_text(spark):
    text = "start " + "one two three " * 30_000 + "four " * 7
    docs = cases.documents(spark, [(1, text, "en", "a", 0), (2, "x", "en", "a", 0)])
    rows = periodic_runs(docs.withColumn("words", words_of(F.col("text")))).collect()
    by_id = {r["row"]["doc_id"]: r for r in rows}
    assert [tuple(r) for r in by_id[1]["runs"]] == [(1, 90_000, 3), (90_001, 7, 1)]
    assert by_id[1]["kept"] == ["start", "one", "two", "three", "four"]


def edited(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_query_on_a_whole_table(spark):
    import hashlib
    from fractions import Fraction

    from tickloom.llm.queries import op13_periodic_runs

    folder = "/root/testdata/sf0.001"
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = set()
    for doc_id, text in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        words = edited(doc_id, cases.words(text))
        runs = fast(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if runs else None
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.add((doc_id, len(runs), *best, milli, sha(listed), sha(kept)))
    assert {tuple(r) for r in op13_periodic_runs(spark, folder).collect()} == want
