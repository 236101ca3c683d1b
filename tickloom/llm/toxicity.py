"""Toxicity by class-conditional Kneser-Ney models.

Two models, of toxic and of ordinary text, give each word a probability after the word before it.
Discounted counts of pairs of words back off, by the mass the discount frees after the first word, to
those of the second word. These are continuation counts, of the distinct words it was seen after in
texts of the class; they back off to those of their stems, their first characters, and these to a
distribution that both classes share, the share of distinct words that begin with the stem. To the
freed mass come counts that weigh the same for either class, so what is too rare for a count of its own
is judged by what it backs off to, and rare stems not at all. For words and stems they stand in for the
freed mass. A passage scores the mean of its words' log-likelihood ratios, as far as they exceed a threshold, where a word right after itself in the same text counts nothing; a document
scores the largest of its passages, so that a few toxic words stand out in a long text. Passages
cover the whole text; a text shorter than a passage scores the mean of its own words. Ratios are rounded to multiples of 1 / STEPS, whose sums are exact, so equal
texts have equal scores. A logistic curve, fitted to the learning
rows through a histogram, turns that into a probability.

Counts cover every pair of words of every learning row and are shuffled as one row per pair and task.
Every pair, word and stem of ``MIN_COUNT`` occurrences whose score differs from what is looked up
without it has an entry of its own in a written table, which grows with the input, and so has every word
before such pairs for what backing off after it adds. Entries whose share of the words learned from reaches ``MIN_SHARE``, at most
1 / MIN_SHARE of each kind, twelve bytes each, are sent to the executors; the others are looked up
by a join with the distinct words of each text that may have one, as far as a filter of fixed size
can tell. Where the border lies decides only how an entry is found, not what a text scores. Of the texts
only those are shuffled, to meet their labels, that filters of ids cannot tell to be plain or unlabelled.

Defined cases: a null or empty text has no words and gets the curve's value at 0. Null ids are never
learned from and not held out. A very long text is scored by its worst passage, wherever it lies.
Repeated rows are scored, and if labelled learned from, each. Without learning rows of both classes
every score is the share of toxic rows among them, 0 if there are none. An empty table gives an empty
result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import reach_workers, text_of
from tickloom.llm.labels import fold, label_of, with_label
from tickloom.session import materialise, small_batches

FOLDS, HELD_OUT = 4, 2
STEM = 4
DISCOUNT = 0.75
BACKOFF = 1.0
PAIR_BACKOFF = 10000.0
MIN_COUNT = 4
MIN_SHARE = 5e-7
FILTER_LONGS = 1 << 21
PAIRS_AT_ONCE = 1 << 20
PASSAGE = 64
MILD = 2.5
STEPS = 1 << 16
BINS = 512
LOWEST, HIGHEST = -0.5, 1.5
# what the first word of a text comes after and what comes after its last one, and what tells the key
# of a word before from its own
START, END, BEFORE = 0x1F3D5B79A2C4E687, 0x3C6EF372FE94F82B, 0x2545F4914F6CDD1D


def model_words(text: Column) -> Column:
    """Runs of letters in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def _word_key(word: Column) -> Column:
    return F.xxhash64(word)


def _stem_key(word: Column) -> Column:
    """Another hash than that of a word, so that words and stems can share a table."""
    return F.xxhash64(F.lit(STEM), F.substring(word, 1, STEM))


def _pair_key(before: Column, word: Column) -> Column:
    """The word's key, combined with that of the word before turned by one bit."""
    turned = F.shiftleft(before, 1).bitwiseOR(F.shiftrightunsigned(before, 63))
    return word.bitwiseXOR(turned)


def learning_rows(texts: DataFrame, known: DataFrame) -> DataFrame:
    """(text, label) of the rows of ``texts`` (doc_id, text) that have a label in ``known``.

    Texts are large and most rows can be told by two filters of ids, which are sent to the executors: a row
    that no labelled id can be is left out, one that no toxic or unlabelled id can be is plain. Only the
    others, toxic ones and what the filters cannot tell, are shuffled to meet their labels.
    """
    reach_workers(texts.sparkSession)
    status = materialise(
        texts.select("doc_id")
        .distinct()
        .join(known.hint("merge"), F.col("doc_id") == F.col("l_id"), "left")
        .select(_id_key(F.col("doc_id")).alias("key"), (F.col("label") >= 0.5).alias("is_toxic")),
        "status",
    )
    filters = (
        held_keys(status.where("is_toxic IS NOT NULL")),
        held_keys(status.where("is_toxic IS NULL OR is_toxic")),
    )
    shared = texts.sparkSession.sparkContext.broadcast(filters)

    def rows(plain: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            labelled, other = shared.value
            for batch in batches:
                keys = batch.column("key").to_numpy()
                left = _may_hold(labelled, keys) & (_may_hold(other, keys) != plain)
                yield batch.select(["doc_id", "text"]).filter(pa.array(left))

        return texts.select(_id_key(F.col("doc_id")).alias("key"), "doc_id", "text").mapInArrow(
            run, "doc_id long, text string"
        )

    told = with_label(rows(plain=False), known).select("text", "label")
    return rows(plain=True).select("text", F.lit(0.0).alias("label")).unionAll(told)


def _id_key(doc_id: Column) -> Column:
    return F.xxhash64(doc_id)


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct pairs of the words of many texts, in order of their second word."""
    parts, size = [], 0

    def counted() -> pa.RecordBatch:
        word, stem, before, toxic = (np.concatenate(column) for column in zip(*parts))
        parts.clear()
        order = np.lexsort((before, word))
        word, before = word[order], before[order]
        starts = np.flatnonzero(np.r_[True, (np.diff(word) != 0) | (np.diff(before) != 0)])
        n = np.diff(np.append(starts, len(word)))
        toxic = np.add.reduceat(toxic[order], starts)
        columns = [word[starts], stem[order[starts]], n, toxic, before[starts]]
        return pa.RecordBatch.from_arrays(
            [pa.array(column) for column in columns], names=["word", "stem", "n", "toxic", "before"]
        )

    for batch in batches:
        words, text = _flat(batch.column("words"))
        stems, _ = _flat(batch.column("stems"))
        if not len(words):
            continue
        first = np.r_[True, text[1:] != text[:-1]]
        before = np.roll(words, 1)
        before[first] = START
        last = np.roll(first, -1)
        toxic = batch.column("is_toxic").to_numpy()[text]
        parts.append((words, stems, before, toxic))
        parts.append((np.full(last.sum(), END), np.zeros(last.sum(), np.int64), words[last], toxic[last]))
        size += len(words)
        if size >= PAIRS_AT_ONCE:
            yield counted()
            size = 0
    if size:
        yield counted()


def word_counts(learning: DataFrame) -> DataFrame:
    """(before, word, stem, n, toxic): occurrences of each word after each other one in learning rows
    (text, label), toxic ones by label; with those of ``END`` after the last words of texts.

    Tasks count the pairs of many texts before they shuffle them. Rows go to a partition by their second
    word and in its order, so that a run of pairs with one word takes little more than the words before.
    """
    reach_workers(learning.sparkSession)
    words = learning.select(
        model_words(F.col("text")).alias("w"), (F.col("label") >= 0.5).cast("long").alias("is_toxic")
    ).select(
        F.transform("w", _word_key).alias("words"), F.transform("w", _stem_key).alias("stems"), "is_toxic"
    )
    return (
        words.mapInArrow(_count_pairs, "word long, stem long, n long, toxic long, before long")
        .repartition("word")
        .groupBy("before", "word", "stem")
        .agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    )


def continuation_counts(pairs: DataFrame) -> DataFrame:
    """(kind, before, word, stem, n, toxic, c_toxic, c_plain): the rows of three tables, by ``kind``.

    Words with the distinct words they come after in either class, and a row for all texts; last words of
    texts; and the pairs of ``MIN_COUNT`` occurrences with their discounted counts.
    """
    plain = F.col("n") - F.col("toxic")
    none, end = F.lit(None).cast("long"), F.col("word") == END
    words = pairs.groupBy("word", "stem").agg(
        F.sum("n").alias("n"),
        F.sum("toxic").alias("toxic"),
        F.sum((F.col("toxic") > 0).cast("double")).alias("c_toxic"),
        F.sum((plain > 0).cast("double")).alias("c_plain"),
    )
    counts = ["n", "toxic", "c_toxic", "c_plain"]
    # ``END`` is told apart by its kind: a filter would be pushed below the shuffle, which both sides share
    kind = F.when(end, "texts").otherwise("word").alias("kind")
    return words.select(kind, none.alias("before"), "word", "stem", *counts).unionAll(
        pairs.where(end | (F.col("n") >= MIN_COUNT)).select(
            F.when(end, "last").otherwise("pair"), "before", "word", "stem", "n", "toxic",
            _discounted(F.col("toxic")), _discounted(plain),
        )
    )


def before_counts(counted: DataFrame) -> DataFrame:
    """(before, n, toxic, c_toxic, c_plain): what comes after a word, and of that the discounted counts of
    frequent pairs; of words that have some.

    A word comes before others as often as it occurs without being the last of a text.
    """
    paired = counted.where("kind = 'pair'").groupBy("before").agg(
        F.sum("c_toxic").alias("c_toxic"), F.sum("c_plain").alias("c_plain")
    )
    # every text with words has one first and one last word
    found = (
        counted.where("kind = 'word'").select(F.col("word").alias("before"), "n", "toxic")
        .unionAll(counted.where("kind = 'last'").select("before", -F.col("n"), -F.col("toxic")))
        .unionAll(counted.where("kind = 'texts'").select(F.lit(START).cast("long"), "n", "toxic"))
    )
    totals = found.groupBy("before").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    return paired.where("c_toxic + c_plain > 0").join(totals, "before")


def _discounted(count: Column) -> Column:
    return F.greatest(count - DISCOUNT, F.lit(0.0))


def _entries(counted: DataFrame) -> DataFrame:
    """Rows with enough occurrences for an entry of their own, with discounted class counts."""
    return counted.where(F.col("n") >= MIN_COUNT).withColumns(
        {"d_toxic": _discounted(F.col("c_toxic")), "d_plain": _discounted(F.col("c_plain"))}
    )


def _counting(ratio: Column) -> Column:
    """What of a ratio counts, as in ``passage_scores``."""
    return ratio - F.greatest(F.least(ratio, F.lit(MILD).cast("float")), F.lit(-MILD).cast("float"))


def fit(learning: DataFrame) -> tuple[DataFrame, float] | None:
    """(key, ratio, sent): log-likelihood ratios of pairs, words and stems and of backing off after a
    word, and which go to the executors; and the largest ratio of backing off."""
    with small_batches(learning.sparkSession):
        counted = materialise(continuation_counts(word_counts(learning)), "counts")
    counts = counted.where("kind = 'word'").drop("kind", "before")
    total, toxic, plain = counts.agg(F.sum("n"), F.sum("c_toxic"), F.sum("c_plain")).first()
    if not total or not toxic or not plain:
        return None
    # shared counts: as many for either class, measured by what each class has of words
    k_toxic, k_plain = BACKOFF, BACKOFF * plain / toxic
    stems = materialise(
        counts.groupBy("stem").agg(
            F.sum("n").alias("n"),
            F.sum("c_toxic").alias("c_toxic"),
            F.sum("c_plain").alias("c_plain"),
            F.count(F.lit(1)).alias("types"),
        ),
        "stems",
    )
    types = float(stems.agg(F.sum("types")).first()[0])
    shared = F.col("types") / types
    stem_table = _entries(stems).select(
        "stem",
        "n",
        "types",
        ((F.col("d_toxic") + k_toxic) / (shared * toxic + k_toxic)).alias("s_toxic"),
        ((F.col("d_plain") + k_plain) / (shared * plain + k_plain)).alias("s_plain"),
    )
    # a word with an entry has at least as many occurrences as its stem needs for one
    word_table = _entries(counts).join(stem_table.drop("n", "types"), "stem")
    in_toxic = (F.col("d_toxic") + F.col("s_toxic") * k_toxic) * (plain / toxic)
    in_plain = F.col("d_plain") + F.col("s_plain") * k_plain
    # whole multiples of a power of two sum without rounding, whatever other texts a batch holds
    in_steps = lambda ratio: (F.round(ratio * STEPS) / STEPS).cast("float")
    sent = (F.col("n") >= math.ceil(total * MIN_SHARE)).alias("sent")
    words = word_table.select(
        "word",
        "n",
        in_toxic.alias("w_toxic"),
        in_plain.alias("w_plain"),
        in_steps(F.log(in_toxic / in_plain)).alias("ratio"),
        in_steps(F.log(F.col("s_toxic") / F.col("s_plain"))).alias("else"),
    )
    # what all words weigh together, those without an entry by their stem
    own = word_table.agg(F.sum("d_plain")).first()[0] or 0.0
    by_stem = stem_table.agg(F.sum(F.col("types") * F.col("s_plain")), F.sum("types")).first()
    weight = own + k_plain * ((by_stem[0] or 0.0) + types - (by_stem[1] or 0))

    # after a word: what its frequent pairs leave of it and the shared counts back off
    p_toxic, p_plain = PAIR_BACKOFF, PAIR_BACKOFF * plain / toxic
    n_toxic, n_plain = F.col("toxic") + p_toxic, F.col("n") - F.col("toxic") + p_plain
    before = before_counts(counted).select(
        "before",
        F.col("n").alias("n_before"),
        n_toxic.alias("n_toxic"),
        n_plain.alias("n_plain"),
        ((n_toxic - F.col("c_toxic")) / n_toxic).alias("b_toxic"),
        ((n_plain - F.col("c_plain")) / n_plain).alias("b_plain"),
    )
    before = materialise(
        before.withColumn("lean", in_steps(F.log(F.col("b_toxic") / F.col("b_plain")))), "before"
    )
    leaning = float(before.agg(F.max(F.abs("lean"))).first()[0] or 0.0)
    pair = lambda c: (
        F.col(f"c_{c}") / F.col(f"n_{c}") + F.col(f"b_{c}") * F.col(f"w_{c}") / F.lit(weight)
    )
    pairs = (
        counted.where("kind = 'pair'")
        .select("before", "word", "n", "c_toxic", "c_plain")
        .join(words.select("word", "w_toxic", "w_plain", F.col("ratio").alias("w_ratio")), "word")
        .join(before, "before")
        .select(
            _pair_key(F.col("before"), F.col("word")).alias("key"),
            in_steps(F.log(pair("toxic") / pair("plain"))).alias("ratio"),
            sent,
            (F.col("w_ratio") + F.col("lean")).alias("else"),
        )
    )
    # an entry matters only where its pair, word or stem would count otherwise without it
    may_count = lambda ratio: F.abs(ratio) + F.lit(leaning) > MILD
    stems_kept = stem_table.select(
        F.col("stem").alias("key"), in_steps(F.log(F.col("s_toxic") / F.col("s_plain"))).alias("ratio"), sent
    ).where(may_count(F.col("ratio")))
    words_kept = words.where(
        (F.col("ratio") != F.col("else")) & (may_count(F.col("ratio")) | may_count(F.col("else")))
    ).select(F.col("word").alias("key"), "ratio", sent)
    before_kept = before.where("lean != 0").select(
        F.col("before").bitwiseXOR(F.lit(BEFORE).cast("long")).alias("key"),
        F.col("lean").alias("ratio"),
        (F.col("n_before") >= math.ceil(total * MIN_SHARE)).alias("sent"),
    )
    pairs_kept = pairs.where(_counting(F.col("ratio")) != _counting(F.col("else"))).drop("else")
    entries = stems_kept.unionAll(words_kept).unionAll(before_kept).unionAll(pairs_kept)
    return materialise(entries, "ratios"), leaning


def sent_part(entries: DataFrame) -> dict[str, np.ndarray]:
    """Sorted keys and ratios of the entries sent, and a filter that passes the keys of all others.

    The filter has one bit for each key, of 64 * FILTER_LONGS. The fuller it is, the more keys without
    an entry pass as well, which then find nothing.
    """
    found = entries.where("sent").select("key", "ratio").toPandas().sort_values("key")
    return {
        "key": found["key"].to_numpy(np.int64),
        "ratio": found["ratio"].to_numpy(np.float32),
        "filter": held_keys(entries.where("NOT sent")),
    }


def held_keys(rows: DataFrame) -> np.ndarray:
    """A filter that passes the ``key`` of every row, and the fuller it is, the more others as well."""
    bit = F.call_function(
        "shiftleft", F.lit(1).cast("long"), F.shiftright("key", 58).bitwiseAND(63).cast("int")
    )
    held = (
        rows.groupBy(F.col("key").bitwiseAND(FILTER_LONGS - 1).alias("at"))
        .agg(F.bit_or(bit).alias("bits"))
        .toPandas()
    )
    bits = np.zeros(FILTER_LONGS, dtype=np.int64)
    bits[held["at"].to_numpy(np.int64)] = held["bits"].to_numpy(np.int64)
    return bits


def _may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return (bits[keys & (len(bits) - 1)] >> (keys >> 58 & 63) & 1).astype(bool)


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of the wanted keys, NaN where there is none."""
    if not len(keys):
        return np.full(len(wanted), np.nan, dtype=np.float32)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, values[at], np.float32(np.nan))


def passage_scores(
    ratios: np.ndarray, offsets: np.ndarray, passage: int, least: int | None = None
) -> np.ndarray:
    """Largest mean over all runs of ``passage`` words of each text.

    Only what a ratio exceeds ``MILD`` by counts: common words of a language with few toxic texts all
    lean to one side a little. Texts shorter than a passage have the mean of their own words; those of
    fewer than ``least`` words, a passage unless given, count as padded to it by neutral words. Texts
    without words score 0.
    """
    out = np.zeros(len(offsets) - 1)
    sizes = np.diff(offsets)
    strong = ratios - np.clip(ratios, -MILD, MILD)
    summed = np.concatenate([[0.0], np.cumsum(strong, dtype=np.float64)])
    short = sizes < passage
    out[short] = (summed[offsets[1:]] - summed[offsets[:-1]])[short]
    out[short] /= np.maximum(sizes[short], max(passage if least is None else least, 1))
    long = np.flatnonzero(~short)
    if len(long):
        runs = (summed[passage:] - summed[:-passage]) / passage
        # maxima over [first, last] run of each text; the runs between belong to two texts
        cuts = np.stack([offsets[:-1][long], offsets[1:][long] - passage + 1], axis=1).ravel()
        padded = np.append(runs, -np.inf)
        out[long] = np.maximum.reduceat(padded, cuts)[::2]
    return out


def _lists(values: np.ndarray, places: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    """The values at ascending ``places`` as one list for each text."""
    cuts = np.searchsorted(places, offsets).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(values))


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values, and the number of the text each belongs to."""
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return values, np.repeat(np.arange(len(lists)), np.diff(offsets))


_OPEN = ("words", "stems", "befores", "pairs")


def _with_sent(docs: DataFrame, sent: dict[str, np.ndarray], leaning: float) -> DataFrame:
    """(row, doc_id, n, at, ratio, open_at, low, lean, words, stems, befores, pairs) of every document.

    The ratios that count, by place, as far as the entries sent tell; ``open_at`` has the places that
    may have another entry, with what the sent ones tell of the word and of the word before it, and the
    keys that may be of others, else 0.
    """
    reach_workers(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(sent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value

        def known(keys: np.ndarray) -> np.ndarray:
            return _look_up(own["key"], own["ratio"], keys)

        for batch in batches:
            words, text = _flat(batch.column("words"))
            stems, _ = _flat(batch.column("stems"))
            sizes = np.bincount(text, minlength=batch.num_rows)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            first = np.ones(len(words), dtype=bool)
            first[1:] = text[1:] != text[:-1]
            before = np.roll(words, 1)
            again = ~first & (words == before)
            before[first] = START
            pairs = words ^ (before << 1 | before >> 63 & 1)
            befores = before ^ BEFORE
            low = known(words)
            rare = np.isnan(low)
            low[rare] = known(stems[rare])
            lean, ratios = known(befores), known(pairs)
            asked = {
                "words": rare & _may_hold(own["filter"], words),
                "stems": np.isnan(low) & _may_hold(own["filter"], stems),
                "pairs": _may_hold(own["filter"], pairs),
            }
            unsure = asked["words"] | asked["stems"]
            np.nan_to_num(low, copy=False, nan=0.0)
            # what a word before leans to matters where it can make a ratio count
            matters = unsure | (np.abs(low) + leaning > MILD)
            asked["befores"] = np.isnan(lean) & matters & _may_hold(own["filter"], befores)
            np.nan_to_num(lean, copy=False, nan=0.0)
            settled = ~np.isnan(ratios) | again
            ratios = np.where(np.isnan(ratios), low + lean, ratios)
            left = np.flatnonzero((unsure | asked["befores"] | asked["pairs"]) & ~settled)
            ratios[again] = 0.0
            ratios[left] = 0.0
            strong = np.flatnonzero(np.abs(ratios) > MILD)
            place = (np.arange(len(words)) - offsets[text]).astype(np.int32)
            keys = {"words": words, "stems": stems, "befores": befores, "pairs": pairs}
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes.astype(np.int32)),
                    _lists(place[strong], strong, offsets),
                    _lists(ratios[strong], strong, offsets),
                    _lists(place[left], left, offsets),
                    _lists(low[left], left, offsets),
                    _lists(lean[left], left, offsets),
                    *[_lists(np.where(asked[k], keys[k], 0)[left], left, offsets) for k in _OPEN],
                ],
                names=["doc_id", "n", "at", "ratio", "open_at", "low", "lean", *_OPEN],
            )

    hashed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), model_words(text_of()).alias("w")
    ).select(
        "doc_id",
        F.transform("w", _word_key).alias("words"),
        F.transform("w", _stem_key).alias("stems"),
    )
    found = hashed.mapInArrow(
        run,
        "doc_id long, n int, at array<int>, ratio array<float>, open_at array<int>, low array<float>, "
        "lean array<float>, " + ", ".join(f"{name} array<long>" for name in _OPEN),
    )
    return materialise(found.withColumn("row", F.monotonically_increasing_id()), "ratios-sent")


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets = np.concatenate([[0], np.cumsum(batch.column("n").to_numpy(), dtype=np.int64)])
        ratios = np.zeros(offsets[-1], dtype=np.float32)
        at, text = _flat(batch.column("at"))
        ratios[offsets[text] + at] = _flat(batch.column("ratio"))[0]
        entries = batch.column("hits").flatten()
        # a key has the same ratio in every text
        keys, first = np.unique(entries.field("key").to_numpy(), return_index=True)
        values = entries.field("ratio").to_numpy()[first]
        open_at, text = _flat(batch.column("open_at"))
        found = {name: _look_up(keys, values, _flat(batch.column(name))[0]) for name in _OPEN}
        chosen = lambda name, other: np.where(np.isnan(found[name]), other, found[name])
        # the word's own entry wins over its stem's, the pair's over both
        low = chosen("words", chosen("stems", _flat(batch.column("low"))[0]))
        lean = chosen("befores", _flat(batch.column("lean"))[0])
        ratios[offsets[text] + open_at] = chosen("pairs", low + lean)
        scores = passage_scores(ratios, offsets, PASSAGE, least=1)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "raw"])


def raw_scores(docs: DataFrame, model: tuple[DataFrame, float] | None) -> DataFrame:
    """(doc_id, raw) of every document."""
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("raw"))
    entries, leaning = model
    found = _with_sent(docs, sent_part(entries), leaning)
    # one row per text and distinct key, whatever the text repeats
    asked = found.select("row", F.explode(F.array_remove(F.array_distinct(F.concat(*_OPEN)), F.lit(0).cast("long"))).alias("key"))
    hits = (
        asked.join(entries.where("NOT sent").select("key", "ratio"), "key")
        .groupBy("row")
        .agg(F.collect_list(F.struct("key", "ratio")).alias("hits"))
    )
    return found.join(hits, "row", "left").drop("row").mapInArrow(_scored, "doc_id long, raw double")


def fit_curve(scored: DataFrame) -> tuple[float, float]:
    """Slope and offset of the logistic curve for rows (raw, label), from a histogram of ``raw``."""
    width = (HIGHEST - LOWEST) / BINS
    bin_ = F.least(F.greatest(F.floor((F.col("raw") - LOWEST) / width), F.lit(0)), F.lit(BINS - 1))
    rows = (
        scored.groupBy(bin_.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("hits"))
        .orderBy("bin")
        .collect()
    )
    n = np.array([r["n"] for r in rows], dtype=float)
    hits = np.array([r["hits"] for r in rows], dtype=float)
    if not len(n) or hits.sum() in (0.0, n.sum()):
        share = hits.sum() / n.sum() if len(n) else 0.0
        return 0.0, float(np.log(share / (1 - share))) if 0 < share < 1 else (40.0 if share else -745.0)
    x = np.array([LOWEST + (r["bin"] + 0.5) * width for r in rows])
    # Platt's targets keep the curve finite where the classes are apart
    high = (hits.sum() + 1) / (hits.sum() + 2)
    low = 1 / (n.sum() - hits.sum() + 2)
    goal = hits * high + (n - hits) * low
    design = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-design @ beta))
        step = np.linalg.solve(
            design.T @ (design * (n * p * (1 - p))[:, None]) + 1e-6 * np.eye(2),
            design.T @ (goal - n * p) - 1e-6 * beta,
        )
        beta = beta + step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def score_toxicity(
    docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT
) -> DataFrame:
    """(doc_id, held_out, raw, score) of every document; labels (doc_id, toxic) of one fold are
    never seen."""
    known = label_of(labels, "toxic").where(fold(F.col("l_id"), folds) != held_out)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).where(
        fold(F.col("doc_id"), folds) != held_out
    )
    model = fit(learning_rows(texts, known))
    with small_batches(docs.sparkSession):
        scored = materialise(raw_scores(docs, model), "raw")
    slope, offset = fit_curve(with_label(scored, known))
    score = 1 / (1 + F.exp(-(F.col("raw") * slope + offset)))
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"),
        "raw",
        score.alias("score"),
    )
