"""Duplicate lines across documents, dropped everywhere but in the first document.

Lines are exploded, normalised and hashed to 128 bits; distinct documents are counted per hash;
positions of lines to drop are gathered per document, which is then put together again from the
slices between them. Only hashes and positions are shuffled for the counting; texts are shuffled
once, to meet their dropped positions. A line that a third of all documents hold is counted through
partial aggregates, and its join partition is one that adaptive execution may split.

Defined cases: a null or empty text is one empty line. A null id counts as one document, larger than any
other. Repeated rows of one id are one document and keep their lines. A very long text is cut at its
lines like any other and put together in one row. Extra columns are carried whatever their names. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import LAST_ID, SPACES, ascii_lower, let, packed, text_key, text_of
from tickloom.session import materialise

MIN_CHARS = 10
MIN_DOCUMENTS = 2


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def shared_lines(docs: DataFrame, min_chars: int, min_documents: int) -> DataFrame:
    """Positions of the lines to drop: one row per text that loses lines, ``gone`` in order."""
    ids = F.coalesce("doc_id", F.lit(LAST_ID))
    text = docs.select(ids.alias("id"), text_of().alias("text"))
    exploded = text.select(
        "id",
        *[h.alias(n) for h, n in zip(text_key(F.col("text")), ("t1", "t2"))],
        F.posexplode(_lines(F.col("text"))).alias("pos", "line"),
    ).withColumn("key", line_key(F.col("line")))
    long_enough = exploded.where(F.char_length("key") >= min_chars)
    hashed = materialise(
        long_enough.select(
            "id", "t1", "t2", "pos", *[h.alias(n) for h, n in zip(text_key(F.col("key")), ("k1", "k2"))]
        ),
        "lines",
    )
    # written, so that both sides of the join are plain exchanges and a hot line's can be split
    shared = materialise(
        hashed.groupBy("k1", "k2")
        .agg(F.min("id").alias("first"), F.count_distinct("id").alias("documents"))
        .where(F.col("documents") >= min_documents)
        .select("k1", "k2", "first"),
        "shared",
    )
    return (
        hashed.join(shared, ["k1", "k2"])
        .where(F.col("id") != F.col("first"))
        .groupBy("id", "t1", "t2")
        .agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    )


def _without(lines: Column, gone: Column) -> Column:
    """Elements at other positions than those in ``gone``: the slices between them, in linear time."""

    def between(cuts: Column, lines: Column) -> Column:
        starts = F.slice(cuts, F.lit(1), F.size(cuts) - 1)
        return F.flatten(
            F.transform(
                starts,
                lambda cut, i: F.slice(lines, cut + 2, F.get(cuts, i + 1) - cut - 1),
            )
        )

    return let(
        lines,
        lambda own: let(
            F.concat(F.array(F.lit(-1)), gone, F.array(F.size(own))),
            lambda cuts: between(cuts, own),
        ),
    )


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """``docs`` with a struct ``lines`` of ``kept`` (text), ``n_lines`` and ``n_dropped``.

    A key of at least ``min_chars`` code points found in at least ``min_documents`` documents stays
    only in the smallest id that holds it, there with all its lines.
    """
    gone = shared_lines(docs, min_chars, min_documents)
    rows = packed(docs)
    text = F.coalesce(F.col("_row.text"), F.lit(""))
    rows = rows.select(
        "_row",
        F.coalesce(F.col("_row.doc_id"), F.lit(LAST_ID)).alias("id"),
        *[h.alias(n) for h, n in zip(text_key(text), ("t1", "t2"))],
    )
    joined = rows.join(gone, ["id", "t1", "t2"], "left")
    kept = F.when(F.col("gone").isNull(), text).otherwise(
        F.array_join(_without(_lines(text), F.col("gone")), "\n")
    )
    n_lines = F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    dropped = F.coalesce(F.size("gone"), F.lit(0))
    dropped = F.when(F.col("gone").isNull(), F.lit(0)).otherwise(dropped)
    out = joined.select(
        "_row",
        F.struct(
            kept.alias("kept"),
            n_lines.cast("long").alias("n_lines"),
            dropped.cast("long").alias("n_dropped"),
        ).alias("_lines"),
    )
    names = [c for c in docs.columns if c != "lines"]
    return out.select(*[F.col("_row").getField(c).alias(c) for c in names], F.col("_lines").alias("lines"))
