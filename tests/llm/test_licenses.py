from __future__ import annotations

import re

import cases

from tickloom.llm.licenses import PHRASES, TEXTS, Template, scan_licenses


def base(text):
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", cases.ascii_lower(text))
    places = [
        (i, t.label)
        for t in PHRASES
        for i in range(len(own) - len(t.words) + 1)
        if own[i : i + len(t.words)] == t.words
    ]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({name for _, name in places}))
    return len(own), len(places), min(starts, default=None), max(starts, default=None), labels


def scan(spark, written, **templates):
    docs = cases.documents(spark, [(i, t, "en", "a", 0) for i, t in enumerate(written)], clashing=True)
    return {r["doc_id"]: r for r in scan_licenses(docs, **templates).collect()}


def test_phrases_word_for_word(spark):
    texts = [r[1] for r in cases.ROWS] + [
        "The MIT-License, and the mit\nlicense; MITlicense mit  licenses",
        "cc by cc by cc, BY",
        "GNU General Public License gnu general public gnu general public license",
        "apache. license Apache é License APACHE LICENSE\x00x",
        "mit Kicense mit li̇cense mİt license",
        "cc",
        "filler " * 5000 + "mit license",
    ]
    got = scan(spark, texts)
    for i, text in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base(text), text
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] == 1 or not r["base_labels"])


def test_texts_with_words_put_in_and_left_out(spark):
    bsd = next(t for t in TEXTS if t.label == "bsd").words
    changed = [*bsd[:9], "one", "two", *bsd[9:14], *bsd[16:]]
    texts = [
        "x y z " + " ".join(changed) + " and more",
        " ".join(bsd[:8]),  # too little of it
        " ".join(bsd[:5]) + " gap" * 60 + " " + " ".join(bsd[5:]),
        "Licensed under CC BY-NC 4.0.",
        "Licensed under the Apache License, Version 2.0.",
        "of the use in the terms of",
    ]
    got = scan(spark, texts)
    assert [got[i]["labels"] for i in range(6)] == ["bsd", "", "bsd", "cc-by,cc-by-nc", "apache,apache-2.0", ""]
    (span,) = got[0]["found"]
    assert 2 <= span["start"] <= 5 and 0.6 <= span["share"] < 1
    assert got[1]["score"] < 0.6


def test_own_templates(spark):
    mine = (Template("own", "one two three four five six seven eight nine ten"),)
    got = scan(spark, ["0 one two three four five six seven eight nine ten"], phrases=(), texts=mine)
    assert (got[0]["labels"], got[0]["score"], got[0]["n_base"]) == ("own", 1.0, 0)


def test_repeated_null_and_no_rows(spark):
    out = scan_licenses(cases.documents(spark))
    assert out.count() == len(cases.ROWS) and out.where("doc_id IS NULL").count() == 2
    assert scan_licenses(cases.none(spark)).count() == 0


def test_query_on_a_whole_table(spark):
    from tickloom.llm.queries import op5_license_scan

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    columns = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    got = {r["doc_id"]: tuple(r[c] for c in columns) for r in op5_license_scan(spark, folder).collect()}
    assert got == {i: base(t) for i, t in docs}
