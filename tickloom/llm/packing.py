"""Packing token sequences by a grouping genetic algorithm on islands.

Documents are turned into token ids, cut into pieces only where they are longer than a sequence.
Shorter pieces are dealt at random to groups of a few thousand, which hold enough small pieces to
fill the sequences that larger ones begin, and whose loss, at most one part-filled sequence each, is
small. Each group is evolved on several islands: a solution is a division of the pieces into bins.
Crossover injects the well-filled bins of one parent whole into the other, removes the bins that held
injected pieces, and puts the pieces displaced by that into the tightest bins that have room. After
every round each island sends its best solution to the next island. An island stops when it reaches
the least number of bins that the tokens need.

Groups have a fixed expected size, so a task's work does not grow with the table. Tokens, pieces and
groups are written to the shared folder between the steps. Solutions depend on seeds only.

Defined cases: a null or empty text is the one token that ends a document. A very long text is encoded
whole, then cut. Repeated rows are packed each. Null ids stay null. An empty table gives an empty
result. Only ``doc_id`` and ``text`` are read, whatever else there is.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import reach_workers, text_of
from tickloom.session import materialise, small_batches

SEQUENCE = 2048
END_ID = 0
GROUP = 4096
ISLANDS = 2
ROUNDS = 2
POPULATION = 4
GENERATIONS = 24
SEED = 29
WORD_CACHE = 350_000
DOCUMENTS_AT_ONCE = 250
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes, word by word through a bounded cache.

    White space always separates tokens, so the ids of a text are those of its words; and where a
    word is made of runs of letters, of digits and of ASCII signs, those of its runs. New runs of
    letters are encoded together, and told apart by the mark that ends each of them.
    """

    def __init__(self, path: str, words: int = WORD_CACHE):
        """Two generations of about ``words`` words are known at a time."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # composed small letters need no normalising and are one run
        self.letters = Tokenizer(self.tokenizer.model)  # one model for both
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        probe = "a the internationalisation zzyzx élan größe \u6f22\u5b57"
        if self._ids(self.letters, [probe]) != self._ids(self.tokenizer, [probe]):
            self.letters = self.tokenizer
        self.words = words
        self.known: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    @staticmethod
    def _ids(tokenizer, texts: list[str]) -> list[bytes]:
        encoded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", one.ids).tobytes() for one in encoded]

    def _learn(self, new: set[str]) -> None:
        known, composed, plain, others = self.known, {}, set(), set()
        for word in new:
            if _is_run(word):
                plain.add(word)
                continue
            # most others are letters before a comma or a full stop
            simple = word[-1] in ".," and _is_run(word[:-1])
            runs = (word[:-1], word[-1]) if simple else _runs(word)
            if runs is None:
                others.add(word)
            else:
                composed[word] = runs
                for run in runs:
                    if run not in known:
                        (plain if run.isalpha() else others).add(run)
        small = [w for w in plain if w.isascii() or w == w.lower() and is_normalized("NFC", w)]
        self._learn_together(self.letters, small, [word.lower() for word in small])
        rest = list(plain.difference(small))
        self._learn_together(self.tokenizer, rest, rest)
        single = list(others)
        known.update(zip(single, self._ids(self.tokenizer, single)))
        for word, runs in composed.items():
            known[word] = b"".join([known[run] for run in runs])

    def _learn_together(self, tokenizer, words: list[str], texts: list[str]) -> None:
        for start in range(0, len(words), 2048):
            part = words[start : start + 2048]
            data = self._ids(tokenizer, [" ".join(texts[start : start + 2048])])[0]
            stops = np.flatnonzero(self.ends[np.frombuffer(data, dtype="<u4")]) + 1
            if len(stops) == len(part):
                at = 0
                for word, stop in zip(part, (stops * 4).tolist()):
                    self.known[word] = data[at:stop]
                    at = stop
            else:  # a vocabulary without the mark
                self.known.update(zip(part, self._ids(self.tokenizer, part)))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for start in range(0, len(texts), DOCUMENTS_AT_ONCE):
            split = [_words(text) for text in texts[start : start + DOCUMENTS_AT_ONCE]]
            found = [list(map(self.known.get, words)) for words in split]
            gaps = [[i for i, ids in enumerate(own) if ids is None] for own in found]
            if len(self.known) > self.words:
                # the generation before is forgotten, this one only as far as it is not used again
                self.known, self.old = {"": b""}, self.known
            new = {words[i] for words, missing in zip(split, gaps) for i in missing}
            back = new & self.old.keys()
            self.known.update((word, self.old[word]) for word in back)
            self._learn(new - back - self.known.keys())
            for words, own, missing in zip(split, found, gaps):
                for i in missing:
                    own[i] = self.known[words[i]]
                yield b"".join(own)


_RUN = re.compile(r"[^\W\d_]+|[0-9]|[!-/:-@\[-`{-~]+")


def _runs(word: str) -> list[str] | None:
    """Runs of letters, single digits and runs of ASCII signs, or None where the tokenizer may see
    other borders: apostrophes, marks of special tokens, other signs, letters that lose one in lower
    case."""
    if "'" in word or "<|" in word:
        return None
    runs = _RUN.findall(word)
    if sum(map(len, runs)) != len(word):
        return None
    return runs if all(run.isascii() or _is_run(run) for run in runs) else None


def _is_run(word: str) -> bool:
    """Letters only, also in lower case: one run to the tokenizer."""
    return word.isalpha() and (word.isascii() or word.islower() or word.lower().isalpha())


def _words(text: str) -> list[str]:
    """Words at white space, in lower case where that is the tokenizer's own, character by character."""
    plain = text.isascii() or ("\u03a3" not in text and is_normalized("NFC", text))
    if plain and "<|" not in text:
        text = text.lower()
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


@cache
def _encoder(path: str) -> Encoder:
    """One per worker process, which keeps its words from task to task."""
    return Encoder(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def cut(ids: bytes, size: int) -> list[tuple[int, bytes]]:
    """Start and ids of each piece of a document."""
    step = size * 4
    return [(start // 4, ids[start : start + step]) for start in range(0, len(ids), step)]


def tokenised(
    docs: DataFrame, tokenizer: str | None = None, size: int = SEQUENCE, with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, the ids."""
    end = array("I", [END_ID]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer or default_tokenizer())
        for batch in batches:
            for first in range(0, batch.num_rows, DOCUMENTS_AT_ONCE):
                part = batch.slice(first, DOCUMENTS_AT_ONCE)
                pieces = [cut(ids + end, size) for ids in encoder.encode(part.column("text").to_pylist())]
                counts = [len(p) for p in pieces]
                flat = [p for own in pieces for p in own]
                columns = [
                    part.column("doc_id").take(pa.array(np.repeat(np.arange(len(pieces)), counts))),
                    pa.array([i for n in counts for i in range(n)], pa.int32()),
                    pa.array([start for start, _ in flat], pa.int64()),
                    pa.array([len(ids) // 4 for _, ids in flat], pa.int64()),
                    pa.array([zlib.crc32(ids) for _, ids in flat], pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    numbers = [np.frombuffer(ids, "<u4").astype(np.int32) for _, ids in flat]
                    columns.append(pa.array(numbers, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))


class Bins:
    """Bins of one capacity, found by the room they have left in a few operations on one integer."""

    def __init__(self, size: int):
        self.size = size
        self.free: list[int] = []
        self.items: list[list[int]] = []
        self.by_room: list[list[int]] = [[] for _ in range(size + 1)]
        self.rooms = 0

    def _file(self, bin_: int) -> None:
        room = self.free[bin_]
        self.by_room[room].append(bin_)
        self.rooms |= 1 << room

    def open(self, items: list[int], room: int) -> None:
        self.free.append(room)
        self.items.append(items)
        self._file(len(self.free) - 1)

    def best_fit(self, item: int, length: int) -> None:
        """Into the tightest bin that has room, else into a new one."""
        fits = self.rooms >> length
        if not fits:
            self.open([item], self.size - length)
            return
        room = length + (fits & -fits).bit_length() - 1
        here = self.by_room[room]
        bin_ = here.pop()
        if not here:
            self.rooms &= ~(1 << room)
        self.items[bin_].append(item)
        self.free[bin_] = room - length
        self._file(bin_)


class Island:
    """A small population of divisions of the same pieces into bins."""

    def __init__(self, lengths: list[int], size: int, seed: list[int]):
        self.lengths, self.size = lengths, size
        self.random = np.random.default_rng(seed)
        self.least = -(-sum(lengths) // size)

    def best_fit(self, order: np.ndarray) -> list[list[int]]:
        bins = Bins(self.size)
        lengths = self.lengths
        for item in order.tolist():
            bins.best_fit(item, lengths[item])
        return bins.items

    def fitness(self, solution: list[list[int]]) -> float:
        """Mean of the squared fills: fewer and unevenly filled bins are better."""
        lengths = self.lengths
        return sum(sum([lengths[i] for i in b]) ** 2 for b in solution) / len(solution)

    def start(self, population: int) -> list[list[list[int]]]:
        lengths = np.array(self.lengths)
        found = [self.best_fit(np.argsort(-lengths, kind="stable"))]
        while len(found) < population and len(found[0]) > self.least:
            noisy = lengths * self.random.uniform(0.8, 1.2, len(lengths))
            found.append(self.best_fit(np.argsort(-noisy, kind="stable")))
        return found

    def cross(self, giver: list[list[int]], taker: list[list[int]]) -> list[list[int]]:
        """The taker with a share of the giver's well-filled bins injected whole."""
        lengths, size = self.lengths, self.size
        fills = np.array([sum([lengths[i] for i in b]) for b in giver])
        share = self.random.uniform(0.2, 0.6)
        good = np.flatnonzero(fills >= np.quantile(fills, 0.5))
        chosen = good[self.random.random(len(good)) < share]
        injected = {i for b in chosen.tolist() for i in giver[b]}
        bins, displaced = Bins(size), []
        for b in chosen.tolist():
            bins.open(list(giver[b]), size - int(fills[b]))
        # bins that are far from full are opened up as well, so their pieces can find better places
        loose = size - max(1, size // 50)
        for b in taker:
            own = [i for i in b if i not in injected]
            fill = sum([lengths[i] for i in own])
            if len(own) < len(b) or (fill < loose and self.random.random() < 0.5):
                displaced += own
            else:
                bins.open(list(b), size - fill)
        for item in sorted(displaced, key=lambda i: (-lengths[i], i)):
            bins.best_fit(item, lengths[item])
        return bins.items

    def evolve(
        self, solutions: list[list[list[int]]], generations: int
    ) -> list[list[list[int]]]:
        """Solutions after some generations, the best first."""
        fit = lambda rated: -rated[0]
        ranked = sorted([(self.fitness(s), s) for s in solutions], key=fit)
        for _ in range(generations):
            if len(ranked[0][1]) <= self.least or len(ranked) < 2:
                break
            a, b = sorted(self.random.choice(len(ranked), 2, replace=False).tolist())
            child = self.cross(ranked[a][1], ranked[b][1])
            ranked = sorted([*ranked, (self.fitness(child), child)], key=fit)[: len(ranked)]
        return [solution for _, solution in ranked]


def _to_bytes(solution: list[list[int]], n: int) -> bytes:
    bins = np.empty(n, dtype="<i4")
    for number, items in enumerate(solution):
        bins[items] = number
    return bins.tobytes()


def _from_bytes(data: bytes) -> list[list[int]]:
    bins = np.frombuffer(data, dtype="<i4")
    if not len(bins):
        return []
    order = np.argsort(bins, kind="stable")
    return [part.tolist() for part in np.split(order, np.cumsum(np.bincount(bins))[:-1])]


def _evolve_batches(round_: int, size: int, seed: int, generations: int, population: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, all_ = [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("group", "island", "lengths", "solutions")))
            for group, island, lengths, solutions in rows:
                own = Island(lengths, size, [seed, group, island, round_])
                begun = [_from_bytes(s) for s in solutions] or own.start(population)
                ranked = own.evolve(begun, generations)
                all_.append([_to_bytes(s, len(lengths)) for s in ranked[:population]])
                best.append(len(ranked[0]))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("group", "island", "rows", "lengths")),
                    pa.array(all_, pa.list_(pa.binary())),
                    pa.array(best, pa.int64()),
                ],
                names=["group", "island", "rows", "lengths", "solutions", "bins"],
            )

    schema = "group long, island int, rows array<long>, lengths array<int>, solutions array<binary>, bins long"
    return lambda df: df.mapInArrow(run, schema)


def _place_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bin and offset of every piece of a group's best solution."""
    for batch in batches:
        for group, rows, lengths, solution in zip(
            *(batch.column(c).to_pylist() for c in ("group", "rows", "lengths", "solution"))
        ):
            length = np.array(lengths, dtype=np.int64)
            bins = np.frombuffer(solution, dtype="<i4")
            order = np.lexsort((np.arange(len(bins)), bins))
            before = np.cumsum(length[order]) - length[order]
            firsts = np.r_[True, np.diff(bins[order]) > 0]
            starts = np.maximum.accumulate(np.where(firsts, before, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(rows, dtype=np.int64)[order]),
                    pa.array(np.full(len(order), group, dtype=np.int64)),
                    pa.array(bins[order].astype(np.int64)),
                    pa.array(before - starts),
                ],
                names=["row", "group", "bin", "offset"],
            )


def pack(
    pieces: DataFrame,
    size: int = SEQUENCE,
    group_size: int = GROUP,
    islands: int = ISLANDS,
    rounds: int = ROUNDS,
    generations: int = GENERATIONS,
    population: int = POPULATION,
    seed: int = SEED,
) -> DataFrame:
    """(row, sequence_id, offset) for pieces (row, length); ``row`` must be unique.

    Pieces that fill a sequence are one by themselves.
    """
    whole = pieces.where(F.col("length") >= size)
    part = pieces.where(F.col("length") < size)
    number = pieces.agg(F.count_if(F.col("length") < size).alias("n")).first()["n"]
    groups = max(1, -(-number // group_size))
    state = materialise(
        part.groupBy(F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(groups)).alias("group"))
        .agg(F.sort_array(F.collect_list(F.struct("row", F.col("length").cast("int").alias("length")))).alias("p"))
        .select(
            "group",
            F.explode(F.array(*[F.lit(i) for i in range(islands)])).alias("island"),
            F.col("p.row").alias("rows"),
            F.col("p.length").alias("lengths"),
            F.array().cast("array<binary>").alias("solutions"),
        )
        .repartition("group", "island"),
        "islands",
    )
    around = W.partitionBy("group").orderBy("island")
    for round_ in range(rounds):
        if round_:
            elite = F.get("solutions", F.lit(0))
            # the best of the island before, for the first one that of the last
            arriving = F.coalesce(
                F.lag(elite).over(around),
                F.last(elite).over(around.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)),
            )
            state = state.withColumn("arriving", arriving).select(
                "group",
                "island",
                "rows",
                "lengths",
                F.concat("solutions", F.array("arriving")).alias("solutions"),
            )
        state = materialise(
            _evolve_batches(round_, size, seed, generations, population)(
                state.select("group", "island", "rows", "lengths", "solutions")
            ),
            "islands",
        )
    by_bins = W.partitionBy("group").orderBy("bins", "island")
    chosen = (
        state.withColumn("rank", F.row_number().over(by_bins))
        .where("rank = 1")
        .select("group", "rows", "lengths", F.get("solutions", F.lit(0)).alias("solution"))
    )
    placed = chosen.mapInArrow(_place_batches, "row long, group long, bin long, offset long")
    # group and bin, and for whole pieces the row, in one number each, told apart by the sign
    shared = placed.select(
        "row", (F.col("group") * F.lit(2 * group_size * 64) + F.col("bin")).alias("sequence_id"), "offset"
    )
    alone = whole.select("row", (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return shared.unionByName(alone)


def pack_documents(
    docs: DataFrame,
    tokenizer: str | None = None,
    size: int = SEQUENCE,
    with_ids: bool = False,
    **settings,
) -> DataFrame:
    """Pieces of all documents with their ``sequence_id`` and ``offset``."""
    reach_workers(docs.sparkSession)
    with small_batches(docs.sparkSession):
        pieces = materialise(
            tokenised(docs, tokenizer, size, with_ids).withColumn("row", F.monotonically_increasing_id()),
            "pieces",
        )
    places = materialise(pack(pieces.select("row", "length"), size, **settings), "places")
    return pieces.join(places, "row").drop("row")
