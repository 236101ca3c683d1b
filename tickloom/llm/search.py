"""Ranked lexical search, reversed: the documents run through an index of the items.

Items are few next to the documents and are known beforehand. Their terms form an inverted index, term
to (item, occurrences), that every executor holds. The documents' counts of the index's terms are
written once, with totals and document frequencies summed on the way. They are then streamed through
the index: a document adds to the score of each item that shares a term with it, and a task keeps, for
each item, a heap of the best documents it has seen. Heaps of the tasks are merged in two steps, so
that no task meets more than a bounded number of heaps of one item.

Items are dealt by hash to blocks of about ``BLOCK_TERMS`` terms. A block is collected, indexed and
sent; further blocks go over the documents again. So what is sent is bounded by the block, not by the
number of items, and no document is left out. A heap has ``k`` entries an item.

Scores are whole numbers of 64 bits throughout; weights are computed in doubles and rounded down.

Defined cases: a null text has no terms. Documents without a term count nowhere. Items without terms
have no result. Equal rows of items count once; items of equal id and different text have a list each.
Equal rows of documents are ranked each, a null id behind all others. Texts are counted whole, however
long. Empty tables give an empty result. Only ``doc_id`` and ``text``, or ``item_id`` and ``text``, are
read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import LAST_ID, reach_workers, text_of
from tickloom.session import materialise

TOP = 10
BLOCK_TERMS = 1 << 20
MERGED = 64
PAIRS = 1 << 20
CELLS = 1 << 21
# Fixed values of the score.
SLOPE, NORM, SCALE, UNIT, ONE = 75, 100, 1_000_000_000, 1000, 8
# Bytes of UTF-8 that belong to terms: digits, letters in lower case, everything beyond ASCII.
_FOLDED = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """Runs of term bytes, A-Z in lower case; all other bytes become spaces."""
    return text.translate(_FOLDED).split()


def _block_of(items: DataFrame, block_terms: int) -> tuple[DataFrame, int]:
    """Distinct items with the block each is dealt to, and the number of blocks."""
    known = items.select("item_id", text_of().alias("text")).distinct()
    known = materialise(known, "items")
    # a term takes at least two bytes of its text, with what parts it from the next one
    size = known.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    blocks = max(1, math.ceil(size / block_terms))
    return known.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), blocks


class Index:
    """Terms of a block of items, and for each its items and how often they hold it."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.ids = [item_id for item_id, _ in items]
        self.number: dict[bytes, int] = {}
        postings: list[list[tuple[int, int]]] = []
        for item, (_, text) in enumerate(items):
            for term, count in Counter(terms(text.encode())).items():
                place = self.number.setdefault(term, len(postings))
                if place == len(postings):
                    postings.append([])
                postings[place].append((item, count))
        self.starts = np.concatenate([[0], np.cumsum([len(p) for p in postings])]).astype(np.int64)
        flat = np.array([pair for p in postings for pair in p], dtype=np.int64).reshape(-1, 2)
        self.items, self.counts = flat[:, 0], flat[:, 1]


def _count_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.number
        known = number.keys()
        for batch in batches:
            sizes, found, often, cuts = [], [], [], [0]
            for text in batch.column("text").cast(pa.binary()):
                own = terms(text.as_py())
                counted = Counter(own)
                held = counted.keys() & known
                sizes.append(len(own))
                found += [number[t] for t in held]
                often += [counted[t] for t in held]
                cuts.append(len(found))
            bounds = pa.array(cuts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(bounds, pa.array(found, pa.int32())),
                    pa.ListArray.from_arrays(bounds, pa.array(often, pa.int32())),
                ],
                names=["doc_id", "n", "terms", "tf"],
            )

    return run


def term_counts(docs: DataFrame, shared) -> DataFrame:
    """(doc_id, n, terms, tf): how many terms each document has, and its counts of the index's."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    counted = texts.mapInArrow(
        _count_batches(shared), "doc_id long, n long, terms array<int>, tf array<int>"
    )
    return counted.where("n > 0")


def weights(counts: DataFrame, n_terms: int, n_docs: int) -> np.ndarray:
    """Weight of every term of the index by the documents that hold it."""
    held = counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    df = np.zeros(n_terms, dtype=np.int64)
    for row in held:
        df[row["term"]] = row["count"]
    return np.array(
        [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64
    )


class _Heaps:
    """The ``k`` best (score, smallest id) of every item, as sorted arrays that take whole strips."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.item, self.score, self.doc = (np.empty(0, dtype=np.int64) for _ in range(3))
        self.least = np.ones(items, dtype=np.int64)

    def offer(self, scores: np.ndarray, docs: np.ndarray) -> None:
        """``scores`` of ``docs`` by row, of the items by column. Equals of the least may win by id."""
        row, item = np.nonzero(scores >= self.least)
        if not len(row):
            return
        item = np.concatenate([self.item, item])
        score = np.concatenate([self.score, scores[row, item[len(self.item) :]]])
        doc = np.concatenate([self.doc, docs[row]])
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        first = np.searchsorted(item, item)
        place = np.arange(len(item)) - first
        best = place < self.k
        self.item, self.score, self.doc = item[best], score[best], doc[best]
        last = place == self.k - 1
        self.least[item[last]] = score[last]


def _rank_batches(shared, k: int, n_docs: int, n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weight = shared.value
        heaps = _Heaps(len(index.ids), k)
        fan = np.diff(index.starts)
        strip = max(1, CELLS // max(1, len(index.ids)))
        for batch in batches:
            lists = batch.column("terms")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            term = lists.values.to_numpy()
            often = batch.column("tf").values.to_numpy().astype(np.int64)
            often = often[batch.column("tf").offsets[0].as_py() :]
            term = term[offsets[0] :]
            offsets -= offsets[0]
            docs = batch.column("doc_id").to_numpy(zero_copy_only=False)
            # m = 25 + 75 n N / L: the length of a document next to the mean one
            size = NORM - SLOPE + SLOPE * batch.column("n").to_numpy().astype(np.int64) * n_docs // n_terms
            for first in range(0, batch.num_rows, strip):
                stop = min(first + strip, batch.num_rows)
                sums = np.zeros((stop - first, len(index.ids)), dtype=np.int64)
                row = np.repeat(np.arange(stop - first), np.diff(offsets[first : stop + 1]))
                own = slice(offsets[first], offsets[stop])
                gain = weight[term[own]] * (
                    SCALE * often[own] // (UNIT * often[own] + ONE * size[first:stop][row])
                )
                # one pair for each document, term and item that holds the term
                reach = np.cumsum(fan[term[own]])
                begin = 0
                while begin < len(reach):
                    before = reach[begin - 1] if begin else 0
                    end = max(int(np.searchsorted(reach, before + PAIRS, "right")), begin + 1)
                    t, r, g = term[own][begin:end], row[begin:end], gain[begin:end]
                    of = np.repeat(np.arange(end - begin), fan[t])
                    at = np.arange(len(of)) - np.repeat(np.cumsum(fan[t]) - fan[t], fan[t]) + index.starts[t][of]
                    np.add.at(sums, (r[of], index.items[at]), g[of] * index.counts[at])
                    begin = end
                heaps.offer(sums, docs[first:stop])
        yield pa.RecordBatch.from_arrays(
            [pa.array(heaps.item), pa.array(heaps.doc), pa.array(heaps.score)], names=["item", "doc_id", "score"]
        )

    return run


def _merged(heaps: DataFrame, k: int) -> DataFrame:
    """Heaps of all tasks to one of each item, first within ``MERGED`` parts of the tasks."""
    order = [F.desc("score"), F.asc("doc_id")]
    parts = W.partitionBy("item", "part").orderBy(*order)
    whole = W.partitionBy("item").orderBy(*order)
    dealt = heaps.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGED)))
    few = dealt.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= k)
    return few.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)


def _search_block(spark: SparkSession, items: DataFrame, docs: DataFrame, k: int) -> DataFrame | None:
    index = Index([(r["item_id"], r["text"]) for r in items.select("item_id", "text").collect()])
    if not index.number:
        return None
    context = spark.sparkContext
    counts = materialise(term_counts(docs, context.broadcast(index)), "term-counts")
    n_docs, n_terms = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    shared = context.broadcast((index, weights(counts, len(index.number), n_docs)))
    ids = F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc_id")
    heaps = counts.select(ids, "n", "terms", "tf").mapInArrow(
        _rank_batches(shared, k, n_docs, n_terms), "item long, doc_id long, score long"
    )
    # as many ids as items of the block
    names = spark.createDataFrame([(i, v) for i, v in enumerate(index.ids)], f"item long, item_id {_kind(items)}")
    return _merged(heaps, k).join(F.broadcast(names), "item").select(
        "item_id", "rank", F.nullif(F.col("doc_id"), F.lit(LAST_ID)).alias("doc_id"), "score"
    )


def _kind(items: DataFrame) -> str:
    return items.schema["item_id"].dataType.simpleString()


def search(
    items: DataFrame, docs: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of the highest score above 0 of each item."""
    spark = docs.sparkSession
    reach_workers(spark)
    known, blocks = _block_of(items, block_terms)
    out = spark.createDataFrame([], f"item_id {_kind(items)}, rank int, doc_id long, score long")
    for block in range(blocks):
        found = _search_block(spark, known.where(F.col("block") == block), docs, k)
        if found is not None:
            out = out.unionByName(found)
    return out
