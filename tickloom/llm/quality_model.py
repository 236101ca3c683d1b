"""Quality classifier: random Fourier features, ridge regression and isotonic calibration.

Each text becomes a row of statistics, computed by column functions. Random Fourier features, cosines
of random projections of the standardised statistics, approximate a Gaussian kernel over them. Every
partition of the learning rows sums its part of the normal equations; the parts are added up entry by
entry, and one linear system of the fixed number of features gives the ridge weights. Their scores
are calibrated by isotonic regression on a histogram of the learning rows.

All labelled rows outside the held-out fold are learned from. What reaches the driver is bounded by
parameters: a square matrix of the number of features, and a histogram. Texts are read once; only
statistics, a few numbers per document, are written and joined to the labels.

Defined cases: a null or empty text has one empty line and is scored like any other. A very long text is
described whole. Null ids are never learned from and not held out. Repeated rows are scored, and if
labelled learned from, each. Several labels of one id are averaged. Without learning rows every score is
0.5. An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import let, reach_workers, text_of, words_of
from tickloom.llm.labels import fold, label_of, with_label
from tickloom.session import materialise

FOLDS, HELD_OUT = 5, 0
FEATURES = 256
KERNEL_WIDTH = 3.0
RIDGE = 1e-3
BINS = 1024
LOWEST, HIGHEST = -0.5, 1.5
SEED = 31


def statistics(text: Column) -> Column:
    """Shares and logarithms that describe a text, none of them its words."""
    chars = F.greatest(F.char_length(text), F.lit(1)).cast("double")

    def matching(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / chars

    def of_words(words: Column) -> Column:
        n = F.greatest(F.size(words), F.lit(1)).cast("double")
        repeats = F.transform(words, lambda w, i: (F.get(words, i - 1) == w).cast("int"))
        repeated = F.aggregate(
            repeats, F.lit(0), lambda total, same: total + F.coalesce(same, F.lit(0))
        )
        return F.array(
            F.log1p(F.size(words).cast("double")),
            F.char_length(F.array_join(words, "")) / n / 10,
            F.size(F.array_distinct(words)) / n,
            repeated / n,
        )

    def of_lines(lines: Column) -> Column:
        n = F.size(lines).cast("double")
        return F.array(F.log1p(n), F.size(F.array_distinct(lines)) / n)

    return F.concat(
        F.array(
            F.log1p(F.char_length(text).cast("double")),
            matching(r"\p{Lu}"),
            matching(r"[#*$%&<>]"),
            matching(r"[|]"),
            matching(r"[!?]"),
            matching(r"[.,;:]"),
            matching(r"[0-9]"),
            matching(r"[\x20\x09-\x0D]"),
        ),
        let(words_of(text), of_words),
        let(F.split(text, "\n", -1), of_lines),
    )


class Fourier:
    """Random Fourier features of standardised statistics, the same for the same seed."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int, width: float, seed: int):
        random = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.weights = random.normal(size=(len(mean), features)) / width
        self.phases = random.uniform(0, 2 * np.pi, features)

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.weights + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(rows), 1))])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column("stats")
    values = lists.values.to_numpy()[lists.offsets[0].as_py() : lists.offsets[-1].as_py()]
    return values.reshape(batch.num_rows, -1)


def fit_ridge(learning: DataFrame, waves: Fourier, ridge: float) -> np.ndarray | None:
    """Weights of the features for rows (stats, label)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(waves.phases) + 1
        total = np.zeros((size, size + 1))
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                x = waves(_matrix(part))
                y = part.column("label").to_numpy()
                total += x.T @ np.hstack([x, y[:, None]])
        if total.any():
            rows = [row.tobytes() for row in total]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(size), pa.int32()), pa.array(rows, pa.binary())], names=["i", "sums"]
            )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, data in zip(batch.column("i").to_pylist(), batch.column("sums").to_pylist()):
                own = np.frombuffer(data)
                sums[i] = sums[i] + own if i in sums else own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
            names=["i", "sums"],
        )

    parts = learning.mapInArrow(partial, "i int, sums binary")
    rows = parts.repartition("i").mapInArrow(added, "i int, sums binary").collect()
    if not rows:
        return None
    total = np.stack([np.frombuffer(bytes(r["sums"])) for r in sorted(rows, key=lambda r: r["i"])])
    normal, right = total[:, :-1], total[:, -1]
    n = normal[-1, -1]
    return np.linalg.solve(normal / n + ridge * np.eye(len(normal)), right / n)


def isotonic(bins: np.ndarray, n: np.ndarray, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and levels of the pools that adjacent violators merge into, levels never falling."""
    pools: list[list[float]] = []
    for centre, count, hit in zip(bins, n, hits):
        pools.append([centre * count, count, hit])
        while len(pools) > 1 and pools[-2][2] / pools[-2][1] >= pools[-1][2] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    table = np.array(pools)
    return table[:, 0] / table[:, 1], table[:, 2] / table[:, 1]


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = FOLDS,
    held_out: int = HELD_OUT,
    features: int = FEATURES,
    width: float = KERNEL_WIDTH,
    ridge: float = RIDGE,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, held_out, raw, score) of every document; labels (doc_id, quality) of one fold are
    never seen."""
    reach_workers(docs.sparkSession)
    stats = materialise(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), statistics(text_of()).alias("stats")),
        "statistics",
    )
    known = label_of(labels, "quality").where(fold(F.col("l_id"), folds) != held_out)
    learning = materialise(with_label(stats, known).select("stats", "label"), "learning")
    held = F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out")
    size = learning.select(F.size("stats").alias("k")).first()
    if size is None:
        half = F.lit(0.5)
        return stats.select("doc_id", held, half.alias("raw"), half.alias("score"))
    columns = [F.get("stats", F.lit(i)) for i in range(size["k"])]
    moments = learning.agg(*[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]).first()
    mean, scale = np.array(moments[: size["k"]]), np.array(moments[size["k"] :])
    waves = Fourier(mean, np.where(scale > 1e-9, scale, 1.0), features, width, seed)
    weights = fit_ridge(learning, waves, ridge)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [batch.slice(s, 2048) for s in range(0, batch.num_rows, 2048)]
            scores = [waves(_matrix(part)) @ weights for part in parts]
            kept = [batch.column(c) for c in batch.schema.names if c != "stats"]
            names = [c for c in batch.schema.names if c != "stats"]
            values = pa.array(np.concatenate(scores) if scores else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*kept, values], names=[*names, "raw"])

    step = (HIGHEST - LOWEST) / BINS
    bin_ = F.least(F.greatest(F.floor((F.col("raw") - LOWEST) / step), F.lit(0)), F.lit(BINS - 1))
    histogram = (
        learning.mapInArrow(raw, "label double, raw double")
        .groupBy(bin_.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("hits"))
        .orderBy("bin")
        .collect()
    )
    centres = np.array([LOWEST + (r["bin"] + 0.5) * step for r in histogram])
    at, level = isotonic(centres, np.array([r["n"] for r in histogram]), np.array([r["hits"] for r in histogram]))

    def calibrated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in raw(batches):
            own = np.interp(batch.column("raw").to_numpy(), at, level)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own)], names=[*batch.schema.names, "score"]
            )

    return stats.select("doc_id", held, "stats").mapInArrow(
        calibrated, "doc_id long, held_out boolean, raw double, score double"
    )
