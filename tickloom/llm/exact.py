"""Exact duplicates by composable polynomial fingerprints.

A text, A-Z in lower case, is cut into chunks of bytes. A chunk's fingerprint is the value of its
bytes as a polynomial at a fixed point, modulo two primes, next to the point's power of the chunk's
length. Two such pairs (h, s) and (h', s') compose to (h * s' + h', s * s'), so the chunks of a huge
text, of more than ``HUGE`` chunks, are dealt out and hashed by as many tasks as there are, and their
pairs are put together in order. Those of other texts are hashed where they are read.

Texts of equal length and fingerprint form a group. Equal fingerprints alone prove nothing: every
member's chunks are compared, chunk by chunk, with those of the group's first row. Members that differ
from it form a group of their own in the next round, until none is left; one round is the rule. A
group's members are dealt over one salt for each ``SALTED`` of them, and the first row's chunks are
repeated once per salt, so a group of a third of all rows spreads over as many keys as it needs. Texts
move once, to meet the rows of groups, and those of groups once more, to meet the first row's chunks.
Every table here grows with the documents, so all joins shuffle both sides, at any size.

Defined cases: null counts as an empty text, and empty texts are equal. A null id is smaller than any
other; of rows equal in text and id one stays. Very long texts are cut, never cut off. An empty table
gives an empty result. Only ``doc_id`` and ``text`` are read, whatever else there is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import ascii_lower, reach_workers, text_of
from tickloom.session import materialise

CHUNK = 1 << 16
HUGE = 16
SALTED = 4096
MAX_ROUNDS = 30
# Primes below 2**31 and a point for each.
PRIMES = (2_147_483_647, 2_147_483_629)
POINTS = (1_812_433_253, 1_103_515_245)
PRINT = ["n_bytes", "h1", "h2"]


def _powers(point: int, prime: int, chunk: int) -> np.ndarray:
    """``point`` to the powers chunk, ..., 1, 0."""
    out = np.ones(chunk + 1, dtype=np.uint64)
    for i in range(1, chunk + 1):
        out[i] = int(out[i - 1]) * point % prime
    return out[::-1].copy()


def _hash_chunks(chunk: int):
    """Adds (h1, s1, h2, s2) to batches that end with a column of chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [_powers(point % prime, prime, chunk) for point, prime in zip(POINTS, PRIMES)]
        for batch in batches:
            hashed = np.empty((4, batch.num_rows), dtype=np.int64)
            for row, value in enumerate(batch.column("chunk")):
                codes = np.frombuffer(value.as_buffer(), dtype=np.uint8).astype(np.uint64)
                first = chunk - len(codes)
                for m, (powers, prime) in enumerate(zip(tables, PRIMES)):
                    # 2**16 products below 2**39 each fit 64 bits
                    hashed[2 * m, row] = int(codes @ powers[first + 1 :]) % prime
                    hashed[2 * m + 1, row] = powers[first]
            columns = [*batch.columns, *[pa.array(values) for values in hashed]]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "h1", "s1", "h2", "s2"])

    return run


def chunks(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per chunk of every text, at least one a text, with the chunk's hash pairs."""
    if not 0 < chunk <= CHUNK:
        raise ValueError(f"a chunk has 1 to {CHUNK} bytes: {chunk}")
    reach_workers(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    starts = F.sequence(F.lit(1), F.greatest(F.octet_length("bytes"), F.lit(1)), F.lit(chunk))
    cut = F.transform(starts, lambda at: F.substring("bytes", at, F.lit(chunk)))

    def spread(some: DataFrame, odd: int) -> DataFrame:
        lowered = some.select("doc_id", F.encode(ascii_lower(F.col("text")), "UTF-8").alias("bytes"))
        return lowered.select(
            (F.monotonically_increasing_id() * 2 + odd).alias("row"),
            "doc_id",
            F.sha2("bytes", 256).alias("sha256"),
            F.octet_length("bytes").cast("long").alias("n_bytes"),
            "bytes",
        ).select("row", "doc_id", "sha256", "n_bytes", F.posexplode(cut).alias("part", "chunk"))

    # lower case takes as many bytes
    is_huge = F.octet_length("text") > HUGE * chunk
    dealt = spread(texts.where(is_huge), 1).repartition("row", "part")
    return spread(texts.where(~is_huge), 0).unionByName(dealt).mapInArrow(
        _hash_chunks(chunk),
        "row long, doc_id long, sha256 string, n_bytes long, part int, chunk binary, "
        "h1 long, s1 long, h2 long, s2 long",
    )


def _composed(pairs: Column, number: int) -> Column:
    """Hash of the chunks put together, from their pairs in order."""
    prime = F.lit(PRIMES[number - 1]).cast("long")
    return F.aggregate(
        pairs,
        F.lit(0).cast("long"),
        lambda h, pair: (h * pair.getField(f"s{number}") + pair.getField(f"h{number}")) % prime,
    )


def fingerprints(cut: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(row, doc_id, sha256, n_bytes, h1, h2) of every text out of the table of its chunks."""
    columns = ["row", "doc_id", "sha256", "n_bytes"]
    short = cut.where(F.col("n_bytes") <= chunk).select(*columns, "h1", "h2")
    pairs = F.sort_array(F.collect_list(F.struct("part", "h1", "s1", "h2", "s2")))
    long = cut.where(F.col("n_bytes") > chunk).groupBy(*columns).agg(pairs.alias("pairs"))
    composed = [_composed(F.col("pairs"), n).alias(f"h{n}") for n in (1, 2)]
    return short.unionByName(long.select(*columns, *composed))


def _same_as_first(members: DataFrame, cut: DataFrame) -> DataFrame:
    """(row, first, same): whether each member's chunks are those of its group's first row.

    ``members`` has row, group, first and n, the members of the group; ``cut`` their chunks.
    """
    salts = F.greatest((F.col("n") / SALTED).cast("int"), F.lit(1))
    own = members.select("row", "first", F.pmod(F.hash("row"), salts).alias("salt"))
    texts = cut.select("row", "part", "chunk").join(own.hint("merge"), "row")
    firsts = members.where(F.col("row") == F.col("first")).select("row", salts.alias("salts"))
    shown = (
        cut.select("row", "part", "chunk")
        .join(firsts.hint("merge"), "row")
        .select(
            F.col("row").alias("first"),
            "part",
            F.col("chunk").alias("shown"),
            F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        )
    )
    compared = texts.join(shown.hint("merge"), ["first", "part", "salt"])
    return compared.groupBy("row", "first").agg(F.bool_and(F.col("chunk") == F.col("shown")).alias("same"))


def _with_first(members: DataFrame) -> DataFrame:
    """``members`` (row, group) with their group's first row and size."""
    sizes = members.groupBy("group").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    return members.join(materialise(sizes, "groups").hint("merge"), "group")


def classes(signed: DataFrame, cut: DataFrame) -> DataFrame:
    """(row, class): rows of equal texts share a class, the smallest row of it.

    ``signed`` is the written table of fingerprints, ``cut`` the written one of chunks.
    """
    shared = signed.groupBy(*PRINT).agg(F.min("row").alias("group"), F.count(F.lit(1)).alias("n"))
    shared = materialise(shared.where("n > 1"), "shared")
    open_rows = materialise(signed.select("row", *PRINT).join(shared.hint("merge"), PRINT).select("row", "group"), "open")
    decided = signed.join(open_rows.hint("merge"), "row", "left_anti").select("row", F.col("row").alias("class"))
    asked = cut.select("row", "part", "chunk").join(open_rows.hint("merge"), "row", "left_semi")
    texts = materialise(asked, "open-chunks", compression="zstd")
    for _ in range(MAX_ROUNDS):
        if open_rows.isEmpty():
            return decided
        members = materialise(_with_first(open_rows), "members")
        compared = materialise(_same_as_first(members, texts), "compared")
        decided = decided.unionByName(compared.where("same").select("row", F.col("first").alias("class")))
        left = compared.where("NOT same").select("row", F.col("first").alias("group"))
        open_rows = materialise(left, "open")
    raise RuntimeError(f"one fingerprint has more than {MAX_ROUNDS} texts")


def exact_duplicates(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, sha256) of every document: of equal texts the row with the
    largest id stays."""
    cut = materialise(chunks(docs, chunk), "chunks", compression="zstd")
    signed = materialise(fingerprints(cut, chunk), "prints")
    classed = materialise(
        classes(signed, cut).join(signed.select("row", "doc_id", "sha256").hint("merge"), "row"), "classes"
    )
    top = F.max(F.struct("doc_id", "row")).alias("top")
    groups = materialise(classed.groupBy("class").agg(top, F.count(F.lit(1)).alias("group_size")), "tops")
    return classed.join(groups.hint("merge"), "class").select(
        "doc_id",
        F.col("top.doc_id").alias("keep_id"),
        "group_size",
        (F.col("top.row") == F.col("row")).alias("kept"),
        "sha256",
    )
