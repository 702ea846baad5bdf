"""Quality classifier by random Fourier features (operator 3).

Each text becomes `STATS` numbers: lengths, shares of kinds of characters, repetition of words and of neighbouring words. Of
these, standardised, D random cosines approximate a Gaussian kernel. A ridge regression of the label on them is solved from
normal equations that are summed by partition; isotonic regression on a fold left out of the ridge turns its values
into probabilities.

What is learned: from rows of `labels` whose crc32(id as text) mod 5 is not 0; of these, remainder 4 calibrates and the
others fit. At most `MAX_TRAIN` rows fit (those with the smallest hashes of the id; 200,000 by default), so that the driver
only ever sees `PARTS` matrices of D x D, and one row for each of 1,001 calibration bins. Label, language, source and id
are no inputs.

Scale: texts are read once to make the statistics, a narrow table, and once more to filter; no text is shuffled.

Edge cases: null and empty texts have all statistics 0 and are scored like any other. Null labels and ids teach nothing; an id labelled
twice counts once, with the larger label. Without any labelled row the score is 0.5. Rows that share an id are scored each by
itself. An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.llm import blocks
from orestrata.llm.shared import cut

D = 256
RIDGE = 1e-3
MAX_TRAIN = 200_000
PARTS = 16
BINS = 1000
THRESHOLD = 0.3
FOLDS = 5

_GROUPS = [b"#*$%&|<>", b"|", b".!?", b",;:", b"0123456789", bytes(range(65, 91)), bytes(range(128, 256)), b"\n", b"'\"()[]{}=@/_-+"]
_CLASSES = np.array([[byte in group for group in _GROUPS] for byte in range(256)], float)
STATS = len(_GROUPS) + 9


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """STATS numbers for each row."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    seen = np.bincount(row * 256 + data, minlength=n * 256).reshape(n, 256)
    starts, ends, at = blocks.words_of(data, offsets)
    hashed = blocks.hashes(data, starts, ends)
    words = np.diff(at)
    owner = np.repeat(np.arange(n), words)
    same = np.zeros(len(hashed), bool)
    same[1:] = (hashed[1:] == hashed[:-1]) & (owner[1:] == owner[:-1])
    pairs = np.zeros(len(hashed), bool)  # every second word equal, as in refrains
    pairs[2:] = (hashed[2:] == hashed[:-2]) & (owner[2:] == owner[:-2])
    key = (owner.astype(np.uint64) << np.uint64(48)) | (hashed >> np.uint64(16))
    distinct, counts = np.unique(key, return_counts=True)
    distinct = (distinct >> np.uint64(48)).astype(np.int64)
    length = (ends - starts).astype(float)
    per_word, per_byte = np.maximum(words, 1), np.maximum(size, 1)
    mean = np.bincount(owner, length, n) / per_word
    spread = np.bincount(owner, (length - mean[owner]) ** 2, n) / per_word
    top = np.zeros(n)
    np.maximum.at(top, distinct, counts)
    columns = [
        np.log1p(words),
        np.log1p(size),
        mean,
        np.sqrt(spread),
        np.bincount(owner, same, n) / per_word,
        np.bincount(owner, pairs, n) / per_word,
        np.bincount(distinct, minlength=n) / per_word,
        top / per_word,
        np.bincount(distinct, counts.astype(float) ** 2, n) / per_word**2,
    ]
    shares = np.sqrt(seen @ _CLASSES / per_byte[:, None])
    return np.column_stack([*columns, shares])


PAGE = 1 << 17  # bytes of text at a time: working arrays take some 100 bytes for each of them


def _table(column: pa.Array) -> np.ndarray:
    data, offsets = blocks.bytes_of(column)
    parts = [statistics(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in blocks.ranges(offsets, PAGE)]
    return np.concatenate(parts) if parts else np.zeros((0, STATS))


def _lists(table: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(table.ravel()), STATS).cast(pa.list_(pa.float64()))


def with_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, stats) for each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(_table(batch.column(1)))], ["id", "stats"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), text_col).mapInArrow(work, f"id {kind}, stats array<double>")


def fold(key: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out. A null id is held out too."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(FOLDS)), F.lit(0)).cast("int")


@dataclass
class Model:
    """Everything that a score needs; a few hundred numbers."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    shift: np.ndarray
    ridge: np.ndarray
    steps: np.ndarray  # raw values, ascending
    levels: np.ndarray  # their probabilities, ascending

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        cosines = np.sqrt(2 / D) * np.cos(x @ self.weights + self.shift)
        return np.column_stack([cosines, np.ones(len(x))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.ridge

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.steps, self.levels), 0, 1)


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence closest to `value` (pool adjacent violators)."""
    means: list[float] = []
    weights: list[float] = []
    sizes: list[int] = []
    for v, w in zip(value, weight):
        means.append(float(v))
        weights.append(float(w))
        sizes.append(1)
        while len(means) > 1 and means[-2] >= means[-1]:
            w2, m2, s2 = weights.pop(), means.pop(), sizes.pop()
            total = weights[-1] + w2
            means[-1] = (means[-1] * weights[-1] + m2 * w2) / total
            weights[-1], sizes[-1] = total, sizes[-1] + s2
    return np.repeat(means, sizes)


def fit(stats: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", max_train: int = MAX_TRAIN) -> Model:
    """The model of `labels[label]`, from the statistics table of `with_statistics`."""
    truth = labels.groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("double").alias("y")).where("y is not null and id is not null")
    train = stats.join(truth, "id").withColumn("fold", fold(F.col("id"))).where("fold <> 0")
    total = train.count()
    share = min(1.0, max_train / max(total, 1))
    train = cut(train.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000)).repartition(PARTS, "id"))

    moments = [F.mean(F.get("stats", F.lit(k))) for k in range(STATS)] + [F.stddev_pop(F.get("stats", F.lit(k))) for k in range(STATS)]
    found = train.agg(F.mean("y"), *moments).first()
    random = np.random.default_rng(7)
    model = Model(
        np.array([x or 0.0 for x in found[1 : STATS + 1]]),
        np.array([x if x and x > 1e-9 else 1.0 for x in found[STATS + 1 :]]),
        random.normal(0, 1 / np.sqrt(STATS), (STATS, D)),
        random.uniform(0, 2 * np.pi, D),
        np.zeros(D + 1),
        np.array([0.0]),
        np.array([0.5 if found[0] is None else found[0]]),
    )
    if found[0] is None:
        return model

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((D + 1, D + 2))
        for batch in batches:
            z = model.features(_array(batch.column(0)))
            total += z.T @ np.column_stack([z, blocks.ints(batch.column(1))])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["matrix"])

    fitted = train.where(f"fold <> {FOLDS - 1}").select("stats", "y")
    sums = sum(np.frombuffer(r[0]).reshape(D + 1, D + 2) for r in fitted.mapInArrow(normal, "matrix binary").collect())
    if isinstance(sums, int) or sums[D, D] == 0:
        return model
    penalty = RIDGE * sums[D, D] * np.eye(D + 1)
    penalty[D, D] = 1e-9
    model.ridge = np.linalg.solve(sums[:, : D + 1] + penalty, sums[:, D + 1])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = np.rint(np.clip(model.raw(_array(batch.column(0))), -1, 2) * BINS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(value), batch.column(1)], ["bin", "y"])

    held = train.where(f"fold = {FOLDS - 1}").select("stats", "y").mapInArrow(binned, "bin bigint, y double")
    bins = held.groupBy("bin").agg(F.mean("y"), F.count("*")).orderBy("bin").collect()
    if bins:
        model.steps = np.array([r[0] for r in bins]) / BINS
        model.levels = isotonic(np.array([r[1] for r in bins]), np.array([r[2] for r in bins]))
    return model


def _array(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), STATS)


def scored(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of `docs`: id_col, held_out, score, predicted (1 from THRESHOLD on)."""
    stats = cut(with_statistics(docs, id_col, text_col))
    model = fit(stats, labels, label, id_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_array(batch.column(1))))], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = stats.select("id", "stats").mapInArrow(work, f"id {kind}, score double")
    return found.select(
        F.col("id").alias(id_col),
        (fold(F.col("id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def good(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose score reaches THRESHOLD, with all their columns."""
    model = fit(cut(with_statistics(docs, id_col, text_col)), labels, label, id_col)

    def reaches(texts: pa.Array) -> pa.Array:
        kept = [np.zeros(0, bool)]
        for lo, hi in blocks.ranges(blocks.bytes_of(texts)[1]):  # a page of texts at a time
            kept.append(model.score(_table(texts.slice(lo, hi - lo))) >= THRESHOLD)
        return pa.array(np.concatenate(kept))

    # Only the text goes to Python; rows stay in the engine and are filtered there.
    return docs.where(F.arrow_udf(reaches, "boolean")(F.col(text_col)))
