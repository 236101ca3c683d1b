from __future__ import annotations

import collections
import random
import zlib

import cases
import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm import packing, simhash
from tickloom.llm.packing import Encoder, Island, default_tokenizer, pack, pack_documents
from tickloom.session import materialise


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


def pieces(tokenizer, text, size=2048):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    return [ids[i : i + size] for i in range(0, len(ids), size)]


def check_sequences(rows, size):
    filled = collections.defaultdict(list)
    for r in rows:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in filled.values():
        place = 0
        for offset, length in sorted(own):
            assert offset == place
            place += length
        assert place <= size
    return len(filled)


def test_words_give_the_tokenizers_ids(tokenizer):
    rng = random.Random(5)
    signs = "aZé'. ,!?#<|>12²½\n\t\r  İKΣσς́ﬁ漢字กั_-’…😀٣Ⅷ\x1c\x0b\x85ß"
    texts = ["".join(rng.choices(signs, k=rng.randrange(50))) for _ in range(3000)]
    texts += ["it's I'LL don't <|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "THE,,. ,the a.b", "", cases.LONG]
    encoder = Encoder(default_tokenizer(), words=50)  # forgets its words all the time
    for text, data in zip(texts, encoder.encode(texts)):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(data, "<u4").tolist() == want, repr(text)


def test_crossover_keeps_every_piece_once():
    rng = np.random.default_rng(1)
    lengths = rng.integers(300, 1500, 400).tolist()
    island = Island(lengths, 2048, [1])
    ranked = island.start(4)
    for child in [island.cross(ranked[0], ranked[1]) for _ in range(20)]:
        assert sorted(i for b in child for i in b) == list(range(400))
        assert all(sum(lengths[i] for i in b) <= 2048 for b in child)
    better = island.evolve(ranked, 30)
    assert island.fitness(better[0]) >= max(map(island.fitness, ranked))
    assert len(better[0]) >= island.least


def triples(n, size, seed):
    """Lengths whose best packing is n full bins of three pieces, one of each over a third."""
    rng = np.random.default_rng(seed)
    lengths = []
    for _ in range(n):
        a = int(rng.integers(int(size * 0.38), int(size * 0.49)))
        b = int(rng.integers(size // 4, (size - a) // 2))
        lengths += [a, b, size - a - b]
    rng.shuffle(lengths)
    return [int(n) for n in lengths]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_evolution_beats_best_fit_decreasing(seed):
    lengths = triples(40, 2048, seed)
    island = Island(lengths, 2048, [1, seed])
    begun = island.start(8)
    evolved = island.evolve(begun, 200)[0]
    assert sorted(i for b in evolved for i in b) == list(range(120))
    assert max(sum(lengths[i] for i in b) for b in evolved) <= 2048
    decreasing = len(begun[0])
    assert decreasing >= 46 and len(evolved) < min(map(len, begun)) and len(evolved) <= decreasing - 3


def test_the_whole_packing_beats_best_fit_decreasing(spark):
    lengths = triples(60, 2048, 4)
    df = spark.createDataFrame(list(enumerate(lengths)), "row long, length long")
    placed = pack(df, generations=150, population=8).join(df, "row").collect()
    used = check_sequences(placed, 2048)
    assert len(placed) == 180
    assert used < len(Island(lengths, 2048, [0]).start(1)[0])


def test_packs_tightly_and_repeats(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice([2048, rng.randrange(1, 2048), rng.randrange(1, 400)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "row long, length long")
    placed = pack(df, group_size=700).join(df, "row").collect()
    assert sorted(r["row"] for r in placed) == list(range(3000))
    used = check_sequences(placed, 2048)
    assert used <= 1.01 * -(-sum(n for _, n in rows) // 2048) + 5
    again = pack(df.repartition(3), group_size=700).join(df, "row").collect()
    assert sorted(map(tuple, placed)) == sorted(map(tuple, again))


def test_documents_of_every_kind(spark, tokenizer):
    docs = cases.documents(spark, clashing=True)
    rows = pack_documents(docs, with_ids=True).collect()
    want = collections.Counter()
    for doc_id, text, *_ in cases.ROWS:
        for i, ids in enumerate(pieces(tokenizer, text)):
            want[doc_id, i, i * 2048, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), tuple(ids)] += 1
    keys = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert collections.Counter((*(r[k] for k in keys), tuple(r["ids"])) for r in rows) == want
    check_sequences(rows, 2048)
    assert pack_documents(cases.none(spark)).count() == 0
    (blank,) = pack_documents(cases.documents(spark, [(1, None, None, None, None)])).collect()
    assert (blank["length"], blank["offset"]) == (1, 0)


def test_other_sizes(spark, tokenizer):
    docs = cases.documents(spark, cases.ROWS[:1])
    rows = pack_documents(docs, size=16).collect()
    assert sorted((r["start"], r["length"]) for r in rows) == [
        (16 * i, len(p)) for i, p in enumerate(pieces(tokenizer, cases.ROWS[0][1], 16))
    ]
    check_sequences(rows, 16)


def test_texts_reach_workers_in_small_batches(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    seen, before = {}, spark.conf.get(name)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})

    rows = [(i, "word " * 4000, "en", "a", 0) for i in range(600)]
    docs = cases.documents(spark, rows).coalesce(1)

    def written(df, step, **options):
        # what a worker gets while the step's table is written
        got = docs.select("text").mapInArrow(sizes, "bytes long").collect()
        seen.setdefault(step, max(r["bytes"] for r in got))
        return materialise(df, step, **options)

    monkeypatch.setattr(packing, "materialise", written)
    monkeypatch.setattr(simhash, "materialise", written)
    few = docs.limit(2)
    pack_documents(few).collect()
    simhash.near_duplicates(few).collect()
    assert seen["pieces"] < 6e6 and seen["fingerprints"] < 6e6 < seen["places"]
    assert spark.conf.get(name) == before
