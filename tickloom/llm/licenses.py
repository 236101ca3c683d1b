"""License statements found by diagonal voting.

The hashes of all rolling word k-grams of the documents are joined with the positions of those of
the templates. A match at document word p and template word t votes for the diagonal p - t, the
place where the template would begin. Votes are counted by diagonal; neighbouring diagonals of one
template are merged, so that a copy with words put in or left out is one span; a span is verified by
the share of the template's words that its matches cover. Matches compare the words themselves as
well, so no hash decides alone. Phrases that must stand word for word need all votes of one diagonal.

Templates are a few hundred k-grams, whatever the corpus, and are sent to all executors. The words of
a document are exploded and joined inside one stage, and only matches, one row per document and
diagonal, are shuffled. A passage that many documents share is matched document by document.

Defined cases: a null or empty text has no words and no labels, and score 0. Repeated rows have a row
each. Null ids stay null. A very long text is scanned whole. An empty table gives an empty result. Only
``doc_id`` and ``text`` are read, whatever else there is.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import ascii_lower, let

LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHORT, LONG = 2, 4
LONG_FROM = 8
NEIGHBOURS = 6
MIN_SHARE = 0.6


class Template(NamedTuple):
    label: str
    text: str
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return re.findall(LICENSE_WORD, self.text.lower())

    @property
    def k(self) -> int:
        return LONG if len(self.words) >= LONG_FROM else SHORT


# Phrases that must stand word for word, and the wording of common licenses.
PHRASES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)
TEXTS = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the "
        "License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    Template(
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files, to deal in the Software without restriction",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    Template(
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation",
    ),
    Template("cc-by-nc", "CC BY-NC"),
    Template("cc-by-sa", "CC BY-SA"),
    Template("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0"),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ),
    Template("all-rights-reserved", "All rights reserved. No part of this publication may be reproduced"),
)


def license_words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(LICENSE_WORD), F.lit(0))


def _grams(words: Column, k: int) -> Column:
    """Hash of every run of ``k`` words."""
    starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - (k - 1), F.lit(0)))
    return F.transform(
        starts, lambda w, i: F.xxhash64(F.lit(k), w, *[F.get(words, i + j) for j in range(1, k)])
    )


def template_grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(hash, template, at, k, gram): the k-grams of the templates, and one row, template -1, that
    stands for each document."""
    rows = [
        (number, at, t.k, t.words[at : at + t.k])
        for number, t in enumerate(templates)
        for at in range(len(t.words) - t.k + 1)
    ]
    grams = spark.createDataFrame(rows, "template int, at int, k int, gram array<string>")
    hashes = [
        F.when(F.col("k") == k, F.xxhash64(F.lit(k), *[F.get("gram", F.lit(j)) for j in range(k)]))
        for k in (SHORT, LONG)
    ]
    hashed = grams.select(F.coalesce(*hashes).alias("hash"), "template", "at", "k", "gram")
    document = spark.range(1).select(
        F.lit(0).cast("long").alias("hash"),
        F.lit(-1).alias("template"),
        F.lit(0).alias("at"),
        F.lit(0).alias("k"),
        F.array().cast("array<string>").alias("gram"),
    )
    return hashed.unionByName(document)


def matches(docs: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """(row, n_words, template, diagonal, seen): votes by diagonal, and one row per document with
    template -1; ``seen`` holds the template positions matched. ``docs`` has row and text."""
    words = docs.select("row", license_words(F.coalesce("text", F.lit(""))).alias("words"))
    hashed = words.select(
        "row",
        "words",
        F.size("words").alias("n_words"),
        let(
            F.col("words"),
            lambda w: F.concat(
                F.array(F.lit(0).cast("long")), _grams(w, SHORT), _grams(w, LONG)
            ),
        ).alias("grams"),
    )
    # outer, as an inner explode makes Catalyst test the array first, which computes it twice
    exploded = hashed.select("row", "words", "n_words", F.posexplode_outer("grams").alias("place", "hash"))
    grams = F.broadcast(template_grams(docs.sparkSession, templates))
    shorts = F.greatest(F.col("n_words") - (SHORT - 1), F.lit(0))
    at_word = F.col("place") - 1 - F.when(F.col("k") == LONG, shorts).otherwise(0)
    joined = exploded.join(grams, "hash").withColumn("word", at_word)
    verified = joined.where(
        F.when(F.col("template") < 0, F.col("place") == 0).otherwise(
            (F.col("place") > 0)
            & (F.slice("words", F.greatest(F.col("word"), F.lit(0)) + 1, F.col("k")) == F.col("gram"))
        )
    )
    return (
        verified.select(
            "row", "n_words", "template", (F.col("word") - F.col("at")).alias("diagonal"), "at"
        )
        .groupBy("row", "n_words", "template", "diagonal")
        .agg(F.collect_set("at").alias("seen"))
    )


def spans(votes: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """(row, n_words, label, phrase, start, share) of verified spans, and one row without a label
    for each document.

    Diagonals of one template at most ``NEIGHBOURS`` words apart are one span; those of phrases
    stay by themselves.
    """
    facts = [(i, t.label, t.phrase, len(t.words), t.k) for i, t in enumerate(templates)]
    facts.append((-1, None, False, 1, 1))
    known = F.broadcast(
        votes.sparkSession.createDataFrame(facts, "template int, label string, phrase boolean, n int, k int")
    )
    along = W.partitionBy("row", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(along)
    begins = F.col("phrase") | F.coalesce(gap > NEIGHBOURS, F.lit(True))
    merged = (
        votes.join(known, "template")
        .withColumn("span", F.sum(begins.cast("int")).over(along.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy("row", "n_words", "template", "label", "phrase", "n", "k", "span")
        .agg(F.min("diagonal").alias("start"), F.flatten(F.collect_list("seen")).alias("seen"))
    )
    covered = F.array_distinct(
        F.flatten(F.transform("seen", lambda at: F.sequence(at, at + F.col("k") - 1)))
    )
    # a phrase is there only if each of its k-grams is
    whole = F.size(F.array_distinct("seen")) == F.col("n") - F.col("k") + 1
    share = F.when(F.col("phrase"), whole.cast("double")).otherwise(F.size(covered) / F.col("n"))
    return merged.withColumn("share", share)


def scan_licenses(
    docs: DataFrame, phrases: tuple[Template, ...] = PHRASES, texts: tuple[Template, ...] = TEXTS
) -> DataFrame:
    """One row per document: its ``doc_id``, ``n_words``, and what was found.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` tell of the phrases; ``labels``
    holds those of the texts too; ``score`` is the largest verified share of a template, 1 for a
    phrase; ``found`` lists the spans (label, start word, share).
    """
    templates = (*phrases, *texts)
    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    # the id goes along with the row number: both are computed once, in the stage that reads texts
    keyed = rows.select(F.struct("row", "doc_id").alias("row"), "text")
    found = spans(matches(keyed, templates), templates)
    is_base = F.col("phrase") & (F.col("share") == 1)
    enough = F.when(F.col("k") == SHORT, F.lit(1.0)).otherwise(MIN_SHARE)
    is_text = ~F.col("phrase") & F.col("label").isNotNull() & (F.col("share") >= enough)
    start = F.col("start").cast("long")
    labels = lambda which: F.array_join(
        F.sort_array(F.collect_set(F.when(which, F.col("label")))), ","
    )
    span = F.struct("label", start.alias("start"), "share")
    return (
        found.groupBy("row", "n_words")
        .agg(
            F.count_if(is_base).alias("n_base"),
            F.min(F.when(is_base, start)).alias("first_word"),
            F.max(F.when(is_base, start)).alias("last_word"),
            labels(is_base).alias("base_labels"),
            labels(is_base | is_text).alias("labels"),
            F.coalesce(F.max(F.when(F.col("label").isNotNull(), F.col("share"))), F.lit(0.0)).alias("score"),
            F.sort_array(F.collect_list(F.when(is_base | is_text, span))).alias("found"),
        )
        .select(
            F.col("row.doc_id").alias("doc_id"),
            F.col("n_words").cast("long").alias("n_words"),
            "n_base",
            "first_word",
            "last_word",
            "base_labels",
            "labels",
            "score",
            "found",
        )
    )
