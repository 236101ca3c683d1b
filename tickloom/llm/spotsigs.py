"""Document fingerprints from spot signatures.

A spot is a common word; its signature is the hash of that word and the chain of the next content
words, common words in between skipped. A fingerprint is the set of a text's signatures, in order,
eight bytes each. Two fingerprints are alike by the Jaccard measure of their sets. Sets whose measure
reaches a threshold t differ in length by at most the factor t, so ``similar_pairs`` deals sets to
partitions of geometric length bounds, where a set meets only its own and the next partition, prunes
candidates by their rarest signatures and by length, and compares what is left exactly.

Fingerprints need no shuffle. Following documents are found through cells of an order: quantiles of
the ids cut the table into cells of a few thousand rows, the first row of each cell is sent to the
cell before it as well, and one shuffle of the texts brings the rows of a cell together.

Where common words are missing, words themselves are spots. A text without a complete chain has the
hashes of all its runs of CHAIN + 1 words; in other texts each content word after GAP content words
without a common word between starts a chain, hashed with its own.

Defined cases: a null text is empty. A text without a complete chain and of fewer words than a run has
one signature, the hash of all its words; a text without words, the hash of the text itself; so no set
is empty and texts that differ only by case, punctuation or white space may share a fingerprint.
Documents of equal id follow each other in the order of their text hashes; null ids come last, ordered
by text hash and split into cells by it. The only row of a table follows itself. A very long text is
signed whole, as one row. Extra columns are not read, whatever their names. An empty table gives an
empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import let, text_key, text_of
from tickloom.session import materialise

# Common words of English, German, French and Spanish.
COMMON_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "als auf das dem den der des die ein eine im in ist mit nicht sich und von zu "
    "au aux dans de des du elle en est et il la le les ou par pas pour que qui sur un une "
    "al como con del el en es esta la las lo los no para por que se su sus un una y"
).split()
CHAIN = 2
GAP = 32
CELL_ROWS = 4096
MAX_CELLS = 8192
NULL_CELLS = 64
BOUND_IDS = 2_000_000
THRESHOLD = 0.8


def signatures(text: Column, common: list[str] = COMMON_WORDS, chain: int = CHAIN) -> Column:
    """The distinct signatures of a text, in order.

    Of several common words in a row the last one is the spot. Chains that run over the end of the
    text are left out.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))

    def spots(words: Column) -> Column:
        places = F.filter(
            F.transform(words, lambda w, i: F.when(w.isin(*common), F.lit(-1)).otherwise(i)),
            lambda i: i >= 0,
        )

        def chains(places: Column) -> Column:
            starts = F.slice(places, F.lit(1), F.greatest(F.size(places) - (chain - 1), F.lit(0)))

            def one(place: Column, j: Column) -> Column:
                after = [F.get(words, F.get(places, j + k)) for k in range(1, chain)]
                behind_spot = place - F.coalesce(F.get(places, j - 1), F.lit(-1)) > 1
                return F.when(
                    behind_spot, F.xxhash64(F.get(words, place - 1), F.get(words, place), *after)
                )

            return F.filter(F.transform(starts, one), lambda h: h.isNotNull())

        def far(places: Column) -> Column:
            """Chains of content words that have only content words for some way before them."""
            starts = F.slice(places, F.lit(1), F.greatest(F.size(places) - chain, F.lit(0)))

            def one(place: Column, j: Column) -> Column:
                run = [F.get(words, F.get(places, j + k)) for k in range(chain + 1)]
                return F.when(place - F.get(places, j - GAP) == GAP, F.xxhash64(*run))

            return F.filter(F.transform(starts, one), lambda h: h.isNotNull())

        def runs(words: Column) -> Column:
            return F.transform(
                F.sequence(F.lit(0), F.size(words) - (chain + 1)),
                lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(chain + 1)]),
            )

        whole = F.when(F.size(words) > 0, F.xxhash64(F.array_join(words, " "))).otherwise(
            F.xxhash64(text)
        )
        def all_of(places: Column) -> Column:
            return let(
                chains(places),
                lambda found: F.when(F.size(found) > 0, F.concat(found, far(places)))
                .when(F.size(words) > chain, runs(words))
                .otherwise(F.array(whole)),
            )

        return F.sort_array(F.array_distinct(let(places, all_of)))

    return let(words, spots)


def fingerprint(signatures: Column) -> Column:
    """The signatures as one string: base64 of their bytes."""
    digits = F.transform(signatures, lambda h: F.lpad(F.hex(h), 16, "0"))
    return F.base64(F.unhex(F.array_join(digits, "")))


def likeness(left: Column, right: Column) -> Column:
    """Jaccard measure of two signature sets, 0 to 1."""
    shared = F.size(F.array_intersect(left, right))
    return shared / (F.size(left) + F.size(right) - shared)


def following(docs: DataFrame) -> DataFrame:
    """(doc_id, text, sigs, next_text, next_sigs): each document with the one of the next larger id.

    After the last document comes the first.
    """
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("t", F.xxhash64("text"))
    number = docs.count()
    cells = int(min(MAX_CELLS, max(1, math.ceil(number / CELL_ROWS))))
    shares = [i / cells for i in range(1, cells)] or [0.5]
    # Bounds decide only where cells end, not who follows whom, so a sample of ids will do for them.
    some = docs.select("doc_id")
    if number > BOUND_IDS:
        some = some.sample(BOUND_IDS / number, seed=1)
    bounds = some.agg(F.percentile_approx("doc_id", shares, 4 * cells + 100)).first()[0] or []
    rows = rows.withColumns(
        {
            "cell": F.when(
                F.col("doc_id").isNull(),
                F.lit(len(bounds) + 1) + (F.shiftright("t", 58) + NULL_CELLS // 2).cast("int"),
            ).otherwise(_cell(F.col("doc_id"), sorted(set(bounds)))),
            # the order inside a cell; rows of a cell have an id each, or none of them has one
            "o": F.coalesce("doc_id", "t"),
        }
    )
    by_cell = W.orderBy("at")
    firsts = rows.groupBy(F.col("cell").alias("at")).agg(F.min("o").alias("first"))
    firsts = firsts.select(
        "at",
        "first",
        F.coalesce(F.lag("at").over(by_cell), F.max("at").over(W.partitionBy())).alias("before"),
    )
    # at most MAX_CELLS + NULL_CELLS + 1 rows of 16 bytes
    firsts = F.broadcast(materialise(firsts, "cells"))
    marked = rows.join(firsts, (F.col("cell") == F.col("at")) & (F.col("o") == F.col("first")), "left")
    border = F.when(
        F.col("before").isNotNull(),
        F.array(
            F.struct(F.col("cell").alias("cell"), F.lit(False).alias("border")),
            F.struct(F.col("before").alias("cell"), F.lit(True).alias("border")),
        ),
    ).otherwise(F.array(F.struct(F.col("cell").alias("cell"), F.lit(False).alias("border"))))
    sent = marked.select("doc_id", "text", "t", "o", F.explode(border).alias("to"))
    gathered = sent.select("doc_id", "text", "t", "o", "to.cell", "to.border").repartition("cell")
    order = W.partitionBy("cell").orderBy("border", "o", "t")
    signed = gathered.withColumn("sigs", signatures(F.col("text")))
    return (
        signed.withColumns(
            {
                "next_text": F.lead("text").over(order),
                "next_sigs": F.lead("sigs").over(order),
            }
        )
        .where(~F.col("border"))
        .select("doc_id", "text", "sigs", "next_text", "next_sigs")
    )


def _cell(value: Column, bounds: list[int]) -> Column:
    """Number of bounds not above ``value``, in two steps of about the root of their number."""
    if not bounds:
        return F.lit(0)
    width = math.isqrt(len(bounds)) + 1
    parts = [bounds[i : i + width] for i in range(0, len(bounds), width)]

    def constant(numbers: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>")

    heads = constant([part[0] for part in parts])
    spread = F.transform(
        F.split(F.lit(";".join(",".join(map(str, p)) for p in parts)), ";"),
        lambda part: F.split(part, ",").cast("array<bigint>"),
    )
    below = F.size(F.filter(heads, lambda b: b <= value))
    inside = F.size(F.filter(F.get(spread, F.greatest(below - 1, F.lit(0))), lambda b: b <= value))
    return F.when(below == 0, F.lit(0)).otherwise((below - 1) * width + inside).cast("int")


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last floor(n / 2) code points replaced by as many of the next text."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(
        F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(next_text, F.lit(1), half)
    )


def similar_pairs(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Classes of equal fingerprints, and pairs of classes that are alike by at least ``threshold``.

    Returns (doc_id, class_id), one row per document, and (left_id, right_id, likeness), the smaller
    class first. A class is named by its smallest doc_id; null ids are in a class named by the other
    ids, or null.
    """
    signed = docs.select("doc_id", signatures(text_of()).alias("sigs"))
    keyed = materialise(
        signed.select("doc_id", "sigs", *[h.alias(n) for h, n in zip(text_key(F.col("sigs")), ("k1", "k2"))]),
        "signatures",
    )
    classes = materialise(
        keyed.groupBy("k1", "k2").agg(F.min("doc_id").alias("class_id"), F.any_value("sigs").alias("sigs")),
        "classes",
    )
    members = keyed.select("doc_id", "k1", "k2").join(classes.drop("sigs"), ["k1", "k2"])
    each = classes.select("k1", "k2", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    held = each.groupBy("sig").agg(F.count(F.lit(1)).alias("held"))
    rare_first = (
        each.join(held, "sig")
        .groupBy("k1", "k2", "n")
        .agg(F.sort_array(F.collect_list(F.struct("held", "sig"))).alias("sigs"))
    )
    prefix = F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - 1e-9).cast("int") + 1
    part = F.floor(F.log(F.col("n").cast("double")) / math.log(1 / threshold) + 1e-9).cast("int")
    probes = rare_first.select(
        "k1", "k2", "n", part.alias("part"), F.explode(F.slice("sigs", F.lit(1), prefix)).alias("s")
    ).select("k1", "k2", "n", "part", F.col("s.sig").alias("sig"))
    left = probes.select(*[F.col(c).alias(f"l_{c}") for c in ("k1", "k2", "n")], "part", "sig")
    right = probes.select(
        *[F.col(c).alias(f"r_{c}") for c in ("k1", "k2", "n")],
        # a set meets its own partition and the one below
        F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("part"),
        "sig",
    )
    ordered = F.struct("l_n", "l_k1", "l_k2") < F.struct("r_n", "r_k1", "r_k2")
    candidates = (
        left.join(right, ["part", "sig"])
        .where(ordered & (F.col("l_n") >= F.col("r_n") * F.lit(threshold) - 1e-9))
        .select("l_k1", "l_k2", "r_k1", "r_k2")
        .distinct()
    )
    one = classes.select(*[F.col(c).alias(f"l_{c}") for c in classes.columns])
    two = classes.select(*[F.col(c).alias(f"r_{c}") for c in classes.columns])
    measured = (
        candidates.join(one, ["l_k1", "l_k2"])
        .join(two, ["r_k1", "r_k2"])
        .withColumn("likeness", likeness(F.col("l_sigs"), F.col("r_sigs")))
        .where(F.col("likeness") >= threshold)
    )
    pairs = measured.select(
        F.least("l_class_id", "r_class_id").alias("left_id"),
        F.greatest("l_class_id", "r_class_id").alias("right_id"),
        "likeness",
    )
    return members.select("doc_id", "class_id"), pairs
