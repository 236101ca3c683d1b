"""Quality rules: base counts of each document and a hashed n-gram log-likelihood ratio.

Word uni- and bigrams are hashed into a fixed number of bins. Two multinomials over the bins are
counted from all documents: the raw corpus, and the trusted documents among them. A bin's weight is
the logarithm of its trusted against its raw share, both drawn to each other by pseudo-counts, so a
bin seen a few times says nothing. A document's score is the mean weight of its n-grams, and a fixed
threshold decides on every document. Weights are whole millionths, so sums do not depend on order.

Counting shuffles one row per bin and task, and texts once, to meet the list of trusted ids. Scoring
shuffles nothing: the weights, one number per bin, are a constant of the plan. No step groups by
document, so long texts, copies and hot sources are ordinary rows.

Defined cases: a null or empty text has no words, fails the base rules and scores 0. A very long text is
counted whole, as one row. Null ids are never trusted. Repeated rows are counted and judged each.
Without trusted documents, or with an empty table, all weights are 0 and the base rules alone decide.
Extra columns are carried, except one named like the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import let, packed, text_of, words_of
from tickloom.session import materialise

BINS = 1 << 14
PSEUDO_COUNT = 16.0
THRESHOLD = -0.08
UNIT = 1_000_000
WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30


def _pairs(hashes: Column, apart: int) -> Column:
    """Hash of each element with the one ``apart`` places on."""
    firsts = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - apart, F.lit(0)))
    return F.transform(firsts, lambda h, i: F.xxhash64(h, F.get(hashes, i + apart)))


def gram_bins(hashes: Column, bins: int) -> Column:
    """Bins of the uni- and bigrams of a text, given the hashes of its words."""
    grams = F.concat(hashes, _pairs(hashes, 1))
    return F.transform(grams, lambda h: F.pmod(h, F.lit(bins)).cast("int"))


def _repeated(windows: Column) -> Column:
    """Words inside windows that occur twice or more, given the hash of each window in order."""
    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(rows: Column) -> Column:
        same = F.filter(
            rows,
            lambda r, i: F.coalesce(F.get(rows, i + 1)["h"] == r["h"], F.lit(False))
            | F.coalesce(F.get(rows, i - 1)["h"] == r["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(same, lambda r: r["i"]))

    def covered(starts: Column) -> Column:
        steps = F.transform(
            starts,
            lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - s, F.lit(WINDOW))),
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    return let(ordered, lambda rows: let(places(rows), covered))


def repeated_words(hashes: Column) -> Column:
    """Number of words in 8-word windows found twice or more; windows are hashed by doubling."""
    windows = let(_pairs(hashes, 1), lambda two: let(_pairs(two, 2), lambda four: _pairs(four, 4)))
    return let(
        windows,
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_repeated(w)),
    )


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    return let(lines, lambda own: F.size(own) - F.size(F.array_distinct(own)))


def gram_weights(
    docs: DataFrame, trusted: DataFrame, bins: int = BINS, pseudo: float = PSEUDO_COUNT
) -> DataFrame:
    """(bin, weight): millionths of the log ratio of trusted to raw share, for every bin.

    ``trusted`` holds the ids of the trusted documents; both counts cover all documents.
    """
    ids = trusted.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("t_id")).distinct()
    # always a shuffled join: the list of ids grows with the documents
    marked = docs.select("doc_id", text_of().alias("text")).join(
        ids.hint("merge"), F.col("doc_id") == F.col("t_id"), "left"
    )
    hashes = F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w))
    counts = materialise(
        marked.select(
            F.col("t_id").isNotNull().cast("long").alias("is_trusted"),
            F.explode(let(hashes, lambda h: gram_bins(h, bins))).alias("bin"),
        )
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("raw"), F.sum("is_trusted").alias("target")),
        "bins",
    )
    totals = counts.agg(F.sum("raw").alias("raw_all"), F.sum("target").alias("target_all"))
    ratio = F.log(
        (F.col("target") * (F.col("raw_all") / F.col("target_all")) + pseudo) / (F.col("raw") + pseudo)
    )
    weight = F.when(F.col("target_all") > 0, F.round(ratio * UNIT).cast("long")).otherwise(0)
    weighted = counts.crossJoin(F.broadcast(totals)).select("bin", weight.alias("weight"))
    every = docs.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(weighted, "bin", "left").select(
        "bin", F.coalesce("weight", F.lit(0)).cast("long").alias("weight")
    )


def bin_table(weights: DataFrame) -> Column:
    """The weights as one constant array; its length is the number of bins, whatever the input."""
    listed = weights.agg(F.sort_array(F.collect_list(F.struct("bin", "weight"))).alias("all"))
    joined = listed.select(F.array_join(F.transform("all", lambda b: b["weight"]), ",")).first()[0]
    return F.split(F.lit(joined), ",").cast("array<bigint>")


def quality_rules(
    docs: DataFrame,
    trusted: DataFrame,
    bins: int = BINS,
    pseudo: float = PSEUDO_COUNT,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` with a struct ``quality``: base counts, ``base_failed``, ``score`` and ``kept``."""
    by_bin = bin_table(gram_weights(docs, trusted, bins, pseudo))

    def counted(words: Column) -> Column:
        hashes = F.transform(words, lambda w: F.xxhash64(w))
        return let(
            hashes,
            lambda h: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
                repeated_words(h).cast("long").alias("n_repeat_words"),
                let(
                    by_bin,
                    lambda table: F.aggregate(
                        gram_bins(h, bins),
                        F.lit(0).cast("long"),
                        lambda total, b: total + F.get(table, b),
                    ),
                ).alias("weight"),
            ),
        )

    text = F.coalesce(F.col("_row.text"), F.lit(""))
    counts = packed(docs).select(
        "_row",
        let(words_of(text), counted).alias("c"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        duplicate_lines(text).cast("long").alias("n_dup_lines"),
    )
    n_words, repeats = F.col("c.n_words"), F.col("c.n_repeat_words")
    failed = (n_words < MIN_WORDS) | (repeats * 100 > n_words * MAX_REPEATED_PERCENT)
    grams = F.greatest(n_words * 2 - 1, F.lit(1))
    kept = ~failed & (F.col("c.weight") >= grams * int(round(threshold * UNIT)))
    quality = F.struct(
        n_words.alias("n_words"),
        F.col("c.word_chars").alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        repeats.alias("n_repeat_words"),
        failed.alias("base_failed"),
        (F.col("c.weight") / grams / UNIT).alias("score"),
        kept.alias("kept"),
    )
    names = [c for c in docs.columns if c != "quality"]
    return counts.select(
        *[F.col("_row").getField(c).alias(c) for c in names], quality.alias("quality")
    )
