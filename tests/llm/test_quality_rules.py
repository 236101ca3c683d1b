from __future__ import annotations

import collections
import random
import re

import cases

from tickloom.llm.quality_rules import quality_rules

COUNTS = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
CLEAN = "the river and a stone of some old town where people walk along every quiet morning".split()
JUNK = "buy### now$$$ the%%% best&&& offer*** win|it cash### for%%% you&&& click*** here$$$ again###".split()


def base(text):
    own = cases.words(text)
    places = collections.defaultdict(list)
    for i in range(len(own) - 7):
        places[tuple(own[i : i + 8])].append(i)
    covered = {i + k for found in places.values() if len(found) > 1 for i in found for k in range(8)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if cases.words(line):
            repeated += line in seen
            seen.add(line)
    n = len(own)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, own)), symbols, repeated, len(covered), failed


def ids(spark, wanted):
    return spark.createDataFrame([(i,) for i in wanted], "doc_id long")


def test_base_counts_of_odd_rows(spark):
    texts = [r[1] for r in cases.ROWS] + [
        "a b c d e f g h " * 3,
        "a b c d e f g h i a b c d e f g h",
        "one two\n\none two\n \n \nthree# four|five",
        "x " * 30,
        "\n".join(f"line {i % 7} with words" for i in range(400)),
    ]
    docs = cases.documents(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)], clashing=True)
    out = quality_rules(docs, ids(spark, [])).collect()
    assert {r["doc_id"]: tuple(r["quality"][c] for c in COUNTS) for r in out} == {
        i: base(t) for i, t in enumerate(texts)
    }
    # nothing is trusted: the base rules alone decide
    assert all(r["quality"]["kept"] == (not r["quality"]["base_failed"]) for r in out)
    assert all(r["quality"]["score"] == 0 and r["size"] == "size" for r in out)


def test_junk_is_rejected_and_clean_documents_stay(spark):
    rng = random.Random(2)
    rows = [
        (i, " ".join(rng.choices(CLEAN if i % 4 else JUNK, k=60)), "en", "a", 0) for i in range(300)
    ]
    docs = cases.documents(spark, rows)
    trusted = ids(spark, [i for i in range(300) if i % 4 and i % 3 == 0] * 2)
    out = quality_rules(docs, trusted).collect()
    assert not [r["doc_id"] for r in out if r["quality"]["kept"] != bool(r["doc_id"] % 4)]
    # the score is the mean weight, so it does not depend on order or partitions
    again = {r["doc_id"]: r["quality"]["score"] for r in quality_rules(docs.repartition(5), trusted).collect()}
    assert again == {r["doc_id"]: r["quality"]["score"] for r in out}


def test_null_ids_repeated_rows_and_empty_tables(spark):
    docs = cases.documents(spark)
    out = quality_rules(docs, spark.createDataFrame([(None,), (5,)], "doc_id long"))
    assert out.count() == len(cases.ROWS)
    assert quality_rules(cases.none(spark), ids(spark, [1])).count() == 0
    blank = cases.documents(spark, [(1, None, "en", "a", 0)])
    (row,) = quality_rules(blank, ids(spark, [1])).collect()
    assert not row["quality"]["kept"] and row["quality"]["score"] == 0
