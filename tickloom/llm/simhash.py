"""Near-duplicate documents by SimHash, compared exactly in tiles.

Each text becomes 64 bits, the majority of the XXH64 hashes of its three-word shingles. Texts of one
fingerprint are one node. Two fingerprints within a radius of r bits agree in at least one of r + 1
blocks of bits, so nodes are dealt to cells by the value of each block; the nodes of a cell, in order
of their bit count, are cut into tiles of bounded size; tiles of a cell are compared pairwise, all
with all, by exclusive or and bit count in numpy, except pairs of tiles whose bit counts differ by
more than the radius. A pair of tiles gives back a spanning forest of its links instead of all of
them, and alternating stars join the forests to components.

Cells are cut into tiles after a range partitioning by (cell, bit count, fingerprint), which spreads
a cell of any size over tasks; a fingerprint that a third of all documents share is one node; the
final join of documents to their node's component is one whose partitions adaptive execution splits.

Defined cases: a null text is empty. Texts without words have fingerprint zero and are linked like any
others; shorter texts than a shingle are hashed whole. A very long text is hashed whole. Null ids take
part; a component of null ids alone has a null id. Repeated rows keep a row each. An empty table gives
an empty result. Only the columns ``doc_id`` and ``text`` are read, whatever else there is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import LAST_ID, packed, reach_workers, text_of
from tickloom.llm.components import connected_components
from tickloom.session import materialise, small_batches

WORDS = 3
HASH_SEED = 42
RADIUS = 3
TILE = 2048
BITS = 64


def simhash(text: bytes, words: int = WORDS, seed: int = HASH_SEED) -> int:
    """Majority bits of the hashes of a text's shingles, as a signed 64-bit number."""
    parts = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not parts:
        return 0
    if len(parts) < words:
        shingles = [b" ".join(parts)]
    else:
        joined = b" ".join(parts)
        ends = np.cumsum([len(p) + 1 for p in parts])
        starts = [0, *ends[:-1].tolist()]
        stops = (ends - 1).tolist()
        shingles = [joined[a:b] for a, b in zip(starts, stops[words - 1 :])]
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(s, seed) for s in shingles]), dtype=np.uint8)
    ones = np.unpackbits(hashes.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(shingles)).tobytes(), "big", signed=True)


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        prints = [simhash(t.as_py()) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("t"), pa.array(prints, pa.int64())],
            names=["doc_id", "t", "fp"],
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, t, fp): the SimHash of every text, and ``t``, a hash to tell texts apart."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), F.xxhash64("text").alias("t")
    )
    return rows.mapInArrow(_hash_batches, "doc_id long, t long, fp long")


def _tile_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one cell in the sorted rows of a task, cut after ``TILE`` rows or at a batch's end."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cells = batch.column("cell").to_numpy()
        counts = batch.column("ones").to_numpy()
        breaks = np.flatnonzero(np.diff(cells)) + 1
        runs = np.concatenate([[0], breaks, [len(cells)]])
        starts = np.concatenate([np.arange(a, b, TILE) for a, b in zip(runs, runs[1:]) if b - a > TILE] or [[]])
        starts = np.unique(np.concatenate([runs[:-1], starts]).astype(np.int64))
        stops = np.append(starts[1:], len(cells))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(cells[starts]),
                pa.array(counts[starts]),
                pa.array(counts[stops - 1]),
                pa.ListArray.from_arrays(pa.array(np.append(starts, len(cells)).astype(np.int32)), batch.column("fp")),
            ],
            names=["cell", "low", "high", "fps"],
        )


def tiles(nodes: DataFrame, radius: int) -> DataFrame:
    """(cell, low, high, fps): the nodes of each cell in order of bit count, in tiles."""
    blocks = radius + 1
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    cells = [
        F.struct(
            F.lit(i).alias("block"),
            F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value"),
        )
        for i, (a, b) in enumerate(zip(edges, edges[1:]))
    ]
    dealt = nodes.select("fp", F.bit_count("fp").alias("ones"), F.explode(F.array(*cells)).alias("c"))
    numbered = dealt.select(
        (F.col("c.value") * blocks + F.col("c.block")).cast("long").alias("cell"), "ones", "fp"
    )
    return (
        numbered.repartitionByRange("cell", "ones", "fp")
        .sortWithinPartitions("cell", "ones", "fp")
        .mapInArrow(_tile_batches, "cell long, low int, high int, fps array<long>")
    )


def _forest(links: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One link per node to another of its component, given links between fingerprints."""
    ends = np.concatenate([np.concatenate(pair) for pair in zip(*links)] or [[]]).astype(np.int64)
    nodes, index = np.unique(ends, return_inverse=True)
    a, b = index[: len(index) // 2], index[len(index) // 2 :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        if np.array_equal(label[a], least) and np.array_equal(label[b], least):
            break
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        label = label[label]
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _compare(left: np.ndarray, right: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links between two tiles, compared in strips of bounded size."""
    found = []
    a, b = left.view(np.uint64), right.view(np.uint64)
    strip = max(1, (1 << 19) // max(1, len(b)))
    for start in range(0, len(a), strip):
        apart = np.bitwise_count(a[start : start + strip, None] ^ b[None, :])
        i, j = np.nonzero(apart <= radius)
        keep = left[start + i] != right[j]
        if keep.any():
            found.append((left[start + i][keep], right[j][keep]))
    return found


def _link_batches(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lefts, rights = batch.column("fps"), batch.column("other")
            l_off, l_all = lefts.offsets.to_numpy(), lefts.values.to_numpy()
            r_off, r_all = rights.offsets.to_numpy(), rights.values.to_numpy()
            found = []
            for k in range(batch.num_rows):
                own = l_all[l_off[k] : l_off[k + 1]]
                found += _compare(own, r_all[r_off[k] : r_off[k + 1]], radius)
            if found:
                a, b = _forest(found)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def near_links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that connect all fingerprints within ``radius`` bits, directly or by others."""
    cut = materialise(tiles(nodes, radius), "tiles")
    first = F.get("fps", F.lit(0))
    one = cut.select("cell", "low", "high", "fps", F.col("low").alias("at"), first.alias("first"))
    two = cut.select(
        "cell",
        F.col("low").alias("o_low"),
        F.col("high").alias("o_high"),
        F.col("fps").alias("other"),
        first.alias("o_first"),
    )
    # a tile's first row in the order of its cell names it
    later = (F.col("o_low") > F.col("low")) | (
        (F.col("o_low") == F.col("low")) & (F.col("o_first") > F.col("first"))
    )
    itself = (F.col("o_low") == F.col("low")) & (F.col("o_first") == F.col("first"))
    reachable = F.col("o_low") - F.col("high") <= radius
    pairs = one.join(two, "cell").where((itself & (F.size("fps") > 1)) | (later & reachable))
    return pairs.select("fps", "other").mapInArrow(_link_batches(radius), "a long, b long")


def components(signed: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root, component_id): of every fingerprint, one that names all it can reach, and the smallest
    document id among these, null if none has an id."""
    nodes = materialise(signed.groupBy("fp").agg(F.min("doc_id").alias("id")), "nodes")
    roots = connected_components(near_links(nodes.select("fp"), radius))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    return materialise(rooted.join(least, "root").select("fp", "root", "component_id"), "components")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, t, fp, component_id) of every document."""
    reach_workers(docs.sparkSession)
    with small_batches(docs.sparkSession):
        signed = materialise(fingerprints(docs), "fingerprints")
    return signed.join(components(signed, radius).drop("root"), "fp")


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each component: the smallest id, of equal ids the smallest text
    hash, of equal texts any one row."""
    reach_workers(docs.sparkSession)
    with small_batches(docs.sparkSession):
        signed = materialise(fingerprints(docs), "fingerprints")
    # one row per fingerprint before anything is joined, however many documents share it
    least = signed.groupBy("fp").agg(
        F.min(F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), "t")).alias("least")
    )
    chosen = (
        least.join(components(signed, radius), "fp")
        .groupBy("root")
        .agg(F.min("least").alias("least"))
        .select(F.col("least.id").alias("id"), F.col("least.t").alias("t"))
    )
    rows = packed(docs).select(
        "_row",
        F.coalesce(F.col("_row.doc_id").cast("long"), F.lit(LAST_ID)).alias("id"),
        F.xxhash64(F.col("_row.text")).alias("t"),
    )
    kept = rows.join(chosen, ["id", "t"], "left_semi").dropDuplicates(["id", "t"])
    return kept.select("_row.*")
