"""Periodic runs of words by internal pattern matching.

A run is a stretch of words with smallest period q, at least ``POWERS`` times q and ``LEAST`` words
long, that no neighbouring word extends. Every run holds a dyadic block: with l the smallest power of
two that is q or more, at least four, some block of l words, of those that begin at multiples of l / 2,
lies so early in the run that it stands in it a second time. The root of a run is primitive, so the
block's occurrences inside the run form a progression of difference q, and the first of them behind the
block gives the period.

The texts of a batch are laid end to end. Ranks of their suffixes, never beyond a text's end, are
doubled until all differ, which gives the suffix array; a block of 2**k words is an interval of it from
the k-th doubling on. The next occurrence of a block behind its own place, inside the neighbouring
window, is the successor of that place among the interval's positions. A wavelet tree of the suffix
array answers all these at once, from the highest bit to the lowest, each level made from the one above
and dropped again. Blocks that stand once in their text are never asked for. Candidates are extended in
both directions, once for each run.

Spark deals the texts out; a text is worked on in one task in O(n log n) time and about 200 bytes a
word. Texts are taken together up to ``BATCH_WORDS`` words, a longer one by itself.

Defined cases: a null or empty text has no words and no runs. A very long text is searched whole, as one
row. Repeated rows have a row each; null ids stay null. An empty table gives an empty result. Columns of
the input are carried in one struct, so any names may occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import reach_workers

POWERS, LEAST = 4, 6
SHORTEST = 4
BATCH_WORDS = 1 << 18


def _heads(keys: np.ndarray) -> np.ndarray:
    """Places where a new value begins."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))


def suffix_array(words: np.ndarray, text: np.ndarray, ends: np.ndarray, starts: np.ndarray):
    """The order of all suffixes, and the blocks that recur in their text as (place, low, high, length).

    ``words`` are numbers, ``text`` the number of each word's text, ``starts`` and ``ends`` that text's
    bounds at each word. A rank is the place of a group's first member in the order, so that it still
    bounds the group when later rounds put its members in order.
    """
    n = len(words)
    keys = text.astype(np.int64) * (int(words.max(initial=0)) + 1) + words
    order = np.argsort(keys, kind="stable")
    ranks = np.empty(n, dtype=np.int64)
    heads = _heads(keys[order])
    sizes = np.diff(np.append(heads, n))
    ranks[order] = np.repeat(heads, sizes)
    places = np.flatnonzero(np.repeat(sizes, sizes) > 1)
    found, length = [], 1
    while len(places):
        own = order[places]
        beyond = own + length
        inside = beyond < ends[own]
        following = np.where(inside, ranks[np.minimum(beyond, n - 1)] + 1, 0)
        keys = ranks[own] * (n + 1) + following
        by = np.argsort(keys, kind="stable")
        own, keys = own[by], keys[by]
        order[places] = own
        heads = _heads(keys)
        sizes = np.diff(np.append(heads, len(keys)))
        lows = np.repeat(places[heads], sizes)
        many = np.repeat(sizes, sizes)
        ranks[own] = lows
        length *= 2
        open_ = many > 1
        places = places[open_]
        if length >= SHORTEST:
            own, lows, many = own[open_], lows[open_], many[open_]
            block = (own - starts[own]) % (length // 2) == 0
            bounds = (own[block], lows[block], lows[block] + many[block])
            found.append(np.stack([*bounds, np.full(block.sum(), length)]))
    return order, np.concatenate(found, axis=1) if found else np.empty((4, 0), dtype=np.int64)


def successors(values: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each query the smallest of ``values[low:high]`` from ``least`` on, -1 if there is none.

    A wavelet tree's levels in turn. A query follows the bits of ``least`` as far as its interval has
    values that share them, and keeps the last sibling to the right that it passed, whose smallest
    value is the answer unless ``least`` itself is there.
    """
    low, high = low.copy(), high.copy()
    sib_low, sib_high = np.zeros_like(low), np.zeros_like(low)
    answer = np.full(len(low), -1, dtype=np.int64)
    for bit in range(int(max(values.max(initial=0), least.max(initial=0))).bit_length() - 1, -1, -1):
        ones = (values >> bit & 1).astype(bool)
        zeros_before = np.concatenate([[0], np.cumsum(~ones)])
        zeros = zeros_before[-1]
        left = lambda at: zeros_before[at]
        right = lambda at: zeros + at - zeros_before[at]
        # the sibling kept goes down to its smallest value
        s_left = left(sib_low), left(sib_high)
        s_right = right(sib_low), right(sib_high)
        has_left = s_left[1] > s_left[0]
        answer = np.where((sib_high > sib_low) & ~has_left, answer | 1 << bit, answer)
        sib_low, sib_high = np.where(has_left, s_left, s_right)
        wants_one = (least >> bit & 1).astype(bool)
        q_left, q_right = (left(low), left(high)), (right(low), right(high))
        passed = ~wants_one & (q_right[1] > q_right[0])
        sib_low = np.where(passed, q_right[0], sib_low)
        sib_high = np.where(passed, q_right[1], sib_high)
        answer = np.where(passed, (least >> bit | 1) << bit, answer)
        low, high = np.where(wants_one, q_right, q_left)
        values = np.concatenate([values[~ones], values[ones]])
    return np.where(high > low, least, answer)


def _reach(same, limit: int) -> int:
    """How many of the first ``limit`` comparisons hold, asked for in growing stretches."""
    done, step = 0, 32
    while done < limit:
        stop = min(done + step, limit)
        wrong = np.flatnonzero(~same(done, stop))
        if len(wrong):
            return done + int(wrong[0])
        done, step = stop, step * 2
    return limit


def _extended(words: np.ndarray, at: int, period: int, first: int, last: int) -> tuple[int, int]:
    """The stretch of this period around ``at`` inside [first, last), of which two roots are known."""
    back = _reach(lambda a, b: (words[at - b : at - a] == words[at - b + period : at - a + period])[::-1], at - first)
    on = _reach(
        lambda a, b: words[at + a : at + b] == words[at + period + a : at + period + b], last - at - period
    )
    return at - back, at + period + on


def find_runs(words: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of the runs of all texts, in that order; starts within the text.

    ``words`` are numbers, equal for equal words, of texts that lie between ``offsets``.
    """
    sizes = np.diff(offsets)
    text = np.repeat(np.arange(len(sizes)), sizes)
    starts, ends = offsets[:-1][text], offsets[1:][text]
    order, (place, low, high, length) = suffix_array(words, text, ends, starts)
    if not len(place):
        return []
    period = successors(order, low, high, place + 1) - place
    # shorter periods are those of shorter blocks; beyond the block there is no progression
    near = (period > 0) & (period <= length) & ((period > length // 2) | (length == SHORTEST))
    place, period = place[near], period[near]
    by = np.lexsort((place, period, text[place]))
    out, known = [], (-1, 0, 0)
    for at, q in zip(place[by].tolist(), period[by].tolist()):
        number = int(text[at])
        if known[:2] == (number, q) and at < known[2]:
            continue
        first, last = int(offsets[number]), int(offsets[number + 1])
        start, stop = _extended(words, at, q, first, last)
        # a block that begins inside this stretch but leaves it may belong to the next one
        known = (number, q, stop - q)
        if stop - start >= max(LEAST, POWERS * q):
            out.append((number, start - first, stop - start, q))
    return sorted(set(out), key=lambda run: (run[0], run[1], run[3]))


def _kept(runs: list[tuple[int, int, int]], n: int) -> list[tuple[int, int]]:
    """[start, stop) of the words that no run holds behind its first root."""
    spans, at = [], 0
    for start, stop in sorted((s + q, s + length) for s, length, q in runs):
        if start > at:
            spans.append((at, start))
        at = max(at, stop)
    if at < n:
        spans.append((at, n))
    return spans


def _lists(rows: list[list[tuple]], kind: pa.DataType) -> pa.Array:
    names = [field.name for field in kind.value_type]
    return pa.array([[dict(zip(names, row)) for row in own] for own in rows], type=kind)


_RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
_SPANS = pa.list_(pa.struct([(name, pa.int32()) for name in ("start", "stop")]))


def _find(batch_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("words")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
            numbers = pc.dictionary_encode(flat).indices.to_numpy(zero_copy_only=False).astype(np.int64)
            offsets -= offsets[0]
            runs: list[list[tuple]] = [[] for _ in range(batch.num_rows)]
            first = 0
            while first < batch.num_rows:
                stop = max(int(np.searchsorted(offsets, offsets[first] + batch_words, "right")) - 1, first + 1)
                own = numbers[offsets[first] : offsets[stop]]
                for number, *found in find_runs(own, offsets[first : stop + 1] - offsets[first]):
                    runs[first + number].append(tuple(found))
                first = stop
            spans = [_kept(own, n) if own else [] for own, n in zip(runs, np.diff(offsets).tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), lists, _lists(runs, _RUNS), _lists(spans, _SPANS)],
                names=["row", "words", "runs", "spans"],
            )

    return run


def periodic_runs(rows: DataFrame, words: str = "words", batch_words: int = BATCH_WORDS) -> DataFrame:
    """(row, words, runs, kept): the columns of ``rows`` but its array ``words`` in a struct, that array,
    its runs by start and period, and the words that no run holds behind its first root."""
    reach_workers(rows.sparkSession)
    carried = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != words])
    own = F.coalesce(F.col(f"`{words}`"), F.array().cast("array<string>"))
    asked = rows.select(carried.alias("row"), own.alias("words"))
    places = lambda kind, *names: T.ArrayType(T.StructType([T.StructField(n, kind) for n in names]))
    schema = T.StructType(
        [
            *asked.schema.fields,
            T.StructField("runs", places(T.LongType(), "start", "length", "period")),
            T.StructField("spans", places(T.IntegerType(), "start", "stop")),
        ]
    )
    found = asked.mapInArrow(_find(batch_words), schema)
    cut = F.flatten(
        F.transform("spans", lambda s: F.slice("words", s["start"] + 1, s["stop"] - s["start"]))
    )
    kept = F.when(F.size("runs") == 0, F.col("words")).otherwise(cut)
    return found.select("row", "words", "runs", kept.alias("kept"))


def strongest(runs: Column) -> Column:
    """The run of the greatest length for its period; of equal ones the first. Null without runs."""
    return F.aggregate(
        runs,
        F.get(runs, F.lit(0)),
        lambda best, run: F.when(
            run["length"] * best["period"] > best["length"] * run["period"], run
        ).otherwise(best),
    )
