"""Mixing sources to target weights by Sainte-Lague apportionment.

Target words go to sources by weight; a source above its cap stops there and the excess is shared
again. The targets are then turned into whole blocks of equal size, given to sources by highest
quotients weight / (2k - 1), and each source's blocks are given to its shards by the same rule. A
shard is a slice of a source by a seeded hash: about sqrt(n) shards of sqrt(n) documents, so neither
a shard nor the list of shards of a source that holds a third of all rows grows beyond one task.
Inside a shard the seeded hash orders the documents into one stream of words that is cut into
blocks. A quota of q blocks in a shard of a blocks takes the whole shard q div a times and the first
q mod a blocks of the seeded stream once more, so documents are taken whole, but for one per shard.
Blocks are never rows: their bounds are arithmetic, and their size costs nothing.

Defined cases: a null or empty text has size 0 and nothing of it is taken. The null source is a source
of its own, ordered last. Repeated rows are separate documents of the stream. Rows of one id, or without
one, share a place in the seeded order; over SAME_PLACE of them have places by all their columns and,
where these are equal as well, by a number, so no shard holds them all. A very long text is one document
like any other. A table without words takes nothing; an empty table gives an empty result. Extra columns
are carried whatever their names, except one named like the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import WORD, number_copies, packed, words_of
from tickloom.session import materialise

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
BLOCK_WORDS = 8
SEED = 17
SAME_PLACE = 64


def count_words(text: Column) -> Column:
    """Number of words of a text; 0 where it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def apportion(
    df: DataFrame, group: list[str], order: list[str], weight: str, total: str, seats: str, cap: str
) -> DataFrame:
    """``df`` with ``quota``: ``seats`` dealt within ``group`` by highest quotients weight / (2k - 1).

    ``total`` is the group's sum of weights. No row gets more than ``cap``; equal quotients go to
    the row earlier in ``order``. Rounding weight * seats / total is the apportionment of a nearby
    number of seats. Only the difference is then dealt, or taken back, by quotient, from candidates
    whose number is at most four times the number of rows.
    """
    whole = W.partitionBy(*group)
    base = F.least(F.floor(F.col(weight) * F.col(seats) / F.col(total) + 0.5), F.col(cap))
    based = df.withColumn("_base", F.when(F.col(total) > 0, base).otherwise(0).cast("long"))
    based = based.withColumns(
        {
            "_open": F.col(seats) - F.sum("_base").over(whole),
            "_rows": F.count(F.lit(1)).over(whole),
        }
    )
    reach = F.ceil(F.col(weight) * (F.abs("_open") + F.col("_rows")) / F.col(total)) + 1
    last = F.when(
        F.col("_open") > 0, F.least(F.col("_base") + reach, F.col(cap))
    ).otherwise(F.greatest(F.col("_base") - reach + 1, F.lit(1)))
    first = F.when(F.col("_open") > 0, F.col("_base") + 1).otherwise(F.col("_base"))
    some = (
        F.when(F.col("_open") > 0, first <= last)
        .when(F.col("_open") < 0, first >= last)
        .otherwise(False)
    )
    # One row without a seat stands for every row of df, so that rows without candidates stay.
    places = F.concat(
        F.array(F.lit(0).cast("long")),
        F.when(some & (F.col(total) > 0), F.sequence(first.cast("long"), last.cast("long"))).otherwise(
            F.array().cast("array<bigint>")
        ),
    )
    candidates = based.withColumn("_seat", F.explode(places)).withColumn(
        "_quotient",
        F.when(F.col("_seat") > 0, F.col(weight) / (F.col("_seat") * 2 - 1)),
    )
    gaining = [F.col("_quotient").desc_nulls_last(), *order]
    losing = [F.col("_quotient").asc_nulls_last(), *[F.col(c).desc() for c in order]]
    ranked = candidates.withColumn(
        "_rank",
        F.when(F.col("_open") > 0, F.row_number().over(whole.orderBy(*gaining))).otherwise(
            F.row_number().over(whole.orderBy(*losing))
        ),
    )
    moved = (F.col("_seat") > 0) & (F.col("_rank") <= F.abs("_open"))
    return (
        ranked.groupBy(*df.columns, "_base", "_open")
        .agg(F.sum(moved.cast("long")).alias("_moved"))
        .withColumn("quota", F.col("_base") + F.signum("_open").cast("long") * F.col("_moved"))
        .drop("_base", "_open", "_moved")
    )


def targets(sizes: DataFrame, weights: tuple[int, ...], max_copies: int) -> DataFrame:
    """(source, source_size, documents, target): all words shared by weight under a cap per source.

    A source reaches its cap exactly if its cap per weight lies below what is left per weight once
    the sources with a smaller cap per weight have theirs, so one ordered pass settles all rounds.
    Runs on one row per source.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    by_cap = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    place = (F.row_number().over(by_name) - 1) % len(weights)
    level = (
        (F.col("words") - max_copies * F.col("capped_before"))
        / (F.col("weights") - F.col("weight_before"))
    )
    full = F.col("source_size") * max_copies <= level * F.col("weight")
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
        .withColumn("weight", F.get(F.array(*map(F.lit, weights)), place).cast("long"))
        .withColumns(
            {
                "words": F.sum("source_size").over(everything),
                "weights": F.sum("weight").over(everything),
                "capped_before": F.coalesce(F.sum("source_size").over(before), F.lit(0)),
                "weight_before": F.coalesce(F.sum("weight").over(before), F.lit(0)),
            }
        )
        .withColumn("level", F.when(~full, level))
        # The first source that is not full fixes the level of all that come after it.
        .withColumn("level", F.max("level").over(everything))
        .select(
            "source",
            "source_size",
            "documents",
            "words",
            F.when(full, F.col("source_size") * float(max_copies))
            .otherwise(F.col("level") * F.col("weight"))
            .cast("double")
            .alias("target"),
        )
    )


def shard_quotas(
    sized: DataFrame, weights: tuple[int, ...], max_copies: int, block: int
) -> tuple[DataFrame, DataFrame]:
    """Targets per source, and per (source, shard) how often it is taken and up to which word again."""
    goals = materialise(targets(sized, weights, max_copies), "targets")
    dealt = apportion(
        goals.withColumns(
            {
                "seats": F.floor(F.col("words") / block + 0.5).cast("long"),
                "cap": (F.ceil(F.col("source_size") / block) * max_copies).cast("long"),
                "all": F.lit(1),
                "source_name": F.coalesce("source", F.lit("")),
                "no_name": F.col("source").isNull(),
            }
        ),
        ["all"],
        ["no_name", "source_name"],
        "target",
        "words",
        "seats",
        "cap",
    ).select("source", "source_size", "documents", "target", F.col("quota").alias("blocks"))
    dealt = materialise(dealt, "quotas")
    shards = (
        in_shards(sized, dealt)
        .groupBy("source", "blocks", "source_size", "target", "shard")
        .agg(F.sum("size").alias("words"))
        .withColumns(
            {
                "own": F.ceil(F.col("words") / block).cast("long"),
                "cap": (F.ceil(F.col("words") / block) * max_copies).cast("long"),
            }
        )
    )
    taken = apportion(
        shards, ["source"], ["shard"], "words", "source_size", "blocks", "cap"
    ).select(
        F.col("source").alias("q_source"),
        F.col("shard").alias("q_shard"),
        "source_size",
        "target",
        F.when(F.col("own") > 0, F.floor(F.col("quota") / F.col("own"))).otherwise(0).alias("whole"),
        F.when(F.col("own") > 0, F.col("quota") % F.col("own") * block).otherwise(0).alias("bound"),
    )
    return dealt, materialise(taken, "shards")


def seeded(doc_id: Column, seed: int) -> Column:
    """The seeded place of a document, as 32 hexadecimal digits."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def spread_places(sized: DataFrame) -> DataFrame:
    """Rows with a place of their own wherever over SAME_PLACE of them share one."""
    others, drawn = number_copies(sized, "place", SAME_PLACE)
    own = F.md5(F.concat_ws(":", "place", "k1", "k2", "number"))
    return others.select(*sized.columns).unionByName(
        drawn.withColumn("place", own).select(*sized.columns)
    )


def in_shards(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with their shard: the leading 32 bits of the seeded hash modulo ceil(sqrt(documents))."""
    counts = sources.select(F.col("source").alias("c_source"), *[c for c in sources.columns if c != "source"])
    shards = F.ceil(F.sqrt("documents")).cast("long")
    number = F.conv(F.substring("place", 1, 8), 16, 10).cast("long")
    return (
        sized.join(counts, F.col("source").eqNullSafe(F.col("c_source")))
        .withColumn("shard", number % shards)
        .drop("c_source", "documents")
    )


def mix_sized(
    sized: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    block: int = BLOCK_WORDS,
) -> DataFrame:
    """Rows (source, size, place, tie, ...) with ``source_size``, ``target``, ``taken``, ``words_more``.

    ``taken`` counts the words taken, repeats included: ``taken div size`` times the whole document
    and then its first ``words_more`` words.
    """
    sized = spread_places(sized)
    narrow = sized.select("source", "size", "place")
    sources, quotas = shard_quotas(narrow, weights, max_copies, block)
    rows = in_shards(sized, sources.select("source", "documents")).join(
        quotas,
        F.col("source").eqNullSafe(F.col("q_source")) & (F.col("shard") == F.col("q_shard")),
    )
    stream = W.partitionBy("q_source", "q_shard").orderBy("place", "size", "tie")
    end = F.sum("size").over(stream.rowsBetween(W.unboundedPreceding, 0))
    more = F.greatest(F.least("end", "bound") - F.col("end") + F.col("size"), F.lit(0)).cast("long")
    return (
        rows.withColumn("end", end)
        .withColumn("words_more", more)
        .withColumn("taken", (F.col("whole") * F.col("size") + F.col("words_more")).cast("long"))
        .drop("q_source", "q_shard", "shard", "end", "bound", "whole")
    )


def mix_texts(docs: DataFrame, seed: int = SEED, **settings) -> DataFrame:
    """The mix itself: every document as often as it is taken, the last time its first words only.

    A document that is cut has its words joined by one space. ``n_chars`` follows the text.
    """
    text = F.col("_row.text")
    sized = packed(docs).select(
        "_row",
        F.col("_row.source").alias("source"),
        count_words(text).alias("size"),
        seeded(F.col("_row.doc_id"), seed).alias("place"),
        F.xxhash64(text).alias("tie"),
    )
    mixed = mix_sized(sized, **settings)
    whole = F.when(F.col("size") > 0, F.floor((F.col("taken") - F.col("words_more")) / F.col("size")))
    copies = F.array_repeat(text, F.coalesce(whole, F.lit(0)).cast("int"))
    # words_more is the whole document again where the stream's bound lies behind it
    again = (
        F.when(F.col("words_more") == 0, F.array().cast("array<string>"))
        .when(F.col("words_more") == F.col("size"), F.array(text))
        .otherwise(
            F.array(F.array_join(F.slice(words_of(text), F.lit(1), F.col("words_more").cast("int")), " "))
        )
    )
    taken = mixed.select("_row", F.explode(F.concat(copies, again)).alias("_text"))
    replaced = {"text": F.col("_text"), "n_chars": F.char_length("_text").cast("long")}
    return taken.select(
        *[replaced.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns]
    )
