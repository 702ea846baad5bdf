"""Toxic spans and document scores by a linear-chain conditional random field (operator 7).

Tokens are runs of letters, digits and non-ASCII characters, ASCII letters in lower case. Each has the label toxic or other; emissions
are sums of weights of hashed features (the token, its first 3, 4, 5 and 6 bytes, its last 3, its length), and neighbours
share transition weights. Forward-backward over the whole text gives every token's marginal; the score of a document is a
logistic function of its largest marginal; tokens of marginal 0.5 or more are the offending ones, with code point offsets.

Labelled tokens come from labelled documents: a token is toxic, in toxic documents, if it or its stem of 4 or 5 bytes is twenty
times as frequent there as in clean ones, and its log-likelihood ratio is significant beyond chance over all that were
tried (`2 ln(tried) + 6`); all others are not. The logistic function's threshold is the one with the fewest errors on the sample.

What is learned: from rows of `labels` whose crc32(id as text) mod 5 is not 0, at most `MAX_DOCS` documents of each class
(those with the smallest hash of the id), and of each at most `WINDOWS` windows of `WIDTH` tokens: bounds of the sample that
is fitted, in the driver. Scores cover whole texts. Language, source and id are no inputs.

Scale: one pass without a shuffle; the sample's ids, bounded, are broadcast to find its texts. A block of texts is one chain,
whose transitions forget the past where a text begins; it is cut into lanes that are multiplied side by side, then joined exactly.

Edge cases: a null or empty text, or one without tokens, has no spans and the score of a largest marginal of 0. Null labels
and ids teach nothing. Without a labelled row of both classes the score is 0. Rows that share an id are scored each by itself. An
empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestrata.llm import blocks
from orestrata.llm.quality import fold
from orestrata.llm.shared import cut

MAX_DOCS = 3000
WINDOWS = 12
WIDTH = 17
SLOTS = 1 << 18
THRESHOLD = 0.5
PREFIXES = (3, 4, 5, 6)
STEMS = (4, 5)
FEATURES = len(PREFIXES) + 3
LANE = 256

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SOLID = np.zeros(256, bool)
_SOLID[48:58] = _SOLID[65:91] = _SOLID[97:123] = _SOLID[128:] = True


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes, starts, ends, and offsets by row of all tokens."""
    lowered = _LOWER[data]
    starts, ends, at = blocks.words_of(np.where(_SOLID[data], lowered, np.uint8(32)), offsets)
    return lowered, starts, ends, at


def features(lowered: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the features of each token, and the tokens' hashes."""
    whole = blocks.hashes(lowered, starts, ends)
    columns = [whole]
    for n in PREFIXES:
        columns.append(blocks.hashes(lowered, starts, np.minimum(starts + n, ends)))
    columns.append(blocks.hashes(lowered, np.maximum(ends - 3, starts), ends))
    columns.append(np.minimum(ends - starts, 20).astype(np.uint64))
    salted = [blocks.mixed(c + blocks.FACTORS[k]) >> np.uint64(64 - 18) for k, c in enumerate(columns)]
    return np.column_stack([c.astype(np.int32) for c in salted]), whole


@dataclass
class Tagger:
    """Weights of the chain (label other has emission 0) and of the document's logistic function."""

    weight: np.ndarray  # SLOTS + 1, the last one is the bias
    move: np.ndarray  # 2 x 2, logs
    start: np.ndarray  # 2, logs
    slope: float = 1.0
    shift: float = 0.0

    def marginals(self, slots: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The chance of toxic for each token; `first` marks the first tokens of texts."""
        n = len(slots)
        if n == 0:
            return np.zeros(0)
        emission = np.exp(np.clip(self.weight[slots].sum(axis=1) + self.weight[-1], -30, 30))
        lanes = -(-n // LANE)
        m = np.ones((2, 2, lanes * LANE))
        move, start = np.exp(self.move), np.exp(self.start)
        for i in range(2):
            for j in range(2):
                m[i, j, :n] = np.where(first, start[j], move[i, j]) * (emission if j else 1.0)
        m /= m.max(axis=(0, 1))
        m = np.ascontiguousarray(m.reshape(2, 2, lanes, LANE).transpose(3, 0, 1, 2))
        product = np.zeros((2, 2, lanes))
        product[0, 0] = product[1, 1] = 1
        for t in range(LANE):
            product = (product[:, :, None] * m[t][None]).sum(axis=1)
            product /= product.max(axis=(0, 1)) + 1e-300
        ahead, behind = np.empty((2, lanes)), np.empty((2, lanes))
        v = np.array([0.5, 0.5])
        for lane in range(lanes):
            ahead[:, lane] = v
            v = v @ product[:, :, lane]
            v /= v.sum()
        v = np.array([0.5, 0.5])
        for lane in reversed(range(lanes)):
            behind[:, lane] = v
            v = product[:, :, lane] @ v
            v /= v.sum()
        forward = np.empty((LANE, 2, lanes))
        v = ahead
        for t in range(LANE):
            v = v[0] * m[t, 0] + v[1] * m[t, 1]
            v /= v.sum(axis=0)
            forward[t] = v
        out = np.empty((LANE, lanes))
        v = behind
        for t in reversed(range(LANE)):
            both = forward[t] * v
            out[t] = both[1] / both.sum(axis=0)
            v = m[t, :, 0] * v[0] + m[t, :, 1] * v[1]
            v /= v.sum(axis=0)
        return out.T.ravel()[:n]

    def score(self, largest: np.ndarray) -> np.ndarray:
        p = np.clip(largest, 1e-9, 1 - 1e-9)
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log(p / (1 - p)) + self.shift, -60, 60)))


def fit_chain(slots: np.ndarray, label: np.ndarray, length: np.ndarray, rounds: int = 60, rate: float = 0.3, ridge: float = 1e-4) -> Tagger:
    """Maximum likelihood by Adagrad over padded windows: slots (n, WIDTH, FEATURES), label (n, WIDTH), length (n)."""
    n, width = label.shape
    tagger = Tagger(np.zeros(SLOTS + 1), np.zeros((2, 2)), np.zeros(2))
    weight, move, start = tagger.weight, tagger.move, tagger.start
    real = np.arange(width)[None, :] < length[:, None]
    flat = slots[real]
    caches = [np.full(x.shape, 1e-8) for x in (weight, move, start)]
    tokens_seen = max(1, real.sum())
    y = label.astype(int)
    for _ in range(rounds):
        emission = np.where(real, np.clip(weight[slots].sum(axis=2) + weight[-1], -30, 30), 0.0)
        score = np.stack([np.zeros_like(emission), emission], axis=2)
        forward, backward = np.zeros((width, n, 2)), np.zeros((width, n, 2))
        forward[0] = start + score[:, 0]
        for t in range(1, width):
            step = np.logaddexp(forward[t - 1][:, :1] + move[0], forward[t - 1][:, 1:] + move[1]) + score[:, t]
            forward[t] = np.where(real[:, t, None], step, forward[t - 1])
        for t in range(width - 2, -1, -1):
            after = score[:, t + 1] + backward[t + 1]
            step = np.logaddexp(after[:, :1] + move[:, 0], after[:, 1:] + move[:, 1])
            backward[t] = np.where(real[:, t + 1, None], step, backward[t + 1])
        total = np.logaddexp(forward[-1][:, 0], forward[-1][:, 1])
        chance = np.exp(forward + backward - total[None, :, None])[:, :, 1].T
        error = np.where(real, y - chance, 0.0)
        pull = np.bincount(flat.ravel(), np.repeat(error[real], slots.shape[2]), SLOTS + 1)[: SLOTS + 1]
        pull[-1] = error.sum()
        moves = np.zeros((2, 2))
        for t in range(1, width):
            ok = real[:, t]
            for i in range(2):
                for j in range(2):
                    pair = np.exp(forward[t - 1][:, i] + move[i, j] + score[:, t, j] + backward[t][:, j] - total)
                    moves[i, j] += ((y[:, t - 1] == i) & (y[:, t] == j) & ok).sum() - pair[ok].sum()
        starts = np.array([((y[:, 0] == j) - np.abs(1 - j - chance[:, 0])).sum() for j in range(2)])
        for x, gradient, cache in zip((weight, move, start), (pull, moves, starts), caches):
            gradient = gradient / tokens_seen - ridge * x / tokens_seen
            cache += gradient**2
            x += rate * gradient / np.sqrt(cache)
    return tagger


def _sample(
    docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, most: int
) -> tuple[DataFrame, dict[int, int]]:
    """(id, text, y) of at most `most` training documents of each class, and how many there are of each."""
    truth = labels.groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("y"))
    truth = truth.where("id is not null and y is not null").where(fold(F.col("id")) != 0)
    labelled = dict(truth.groupBy("y").count().collect())
    picked = [truth.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(most) for y in (0, 1)]
    ids = cut(picked[0].unionByName(picked[1]))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return cut(rows.join(F.broadcast(ids), "id")), labelled  # at most 2 x most rows are broadcast


def units(lowered: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of each token and of its stems, a row for each kind; a token without that stem repeats itself."""
    whole = blocks.hashes(lowered, starts, ends)
    out = [whole]
    for n in STEMS:
        stem = blocks.hashes(lowered, starts, np.minimum(starts + n, ends))
        out.append(np.where(ends - starts > n, blocks.mixed(stem + blocks.FACTORS[20 + n]), whole))
    return np.stack(out)


def _lexicon(sample: DataFrame) -> np.ndarray:
    """Hashes of the tokens and stems that tell toxic documents from clean ones."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = blocks.bytes_of(batch.column(0))
            label = blocks.ints(batch.column(1))
            for lo, hi in blocks.ranges(offsets):
                base = offsets[lo]
                lowered, starts, ends, at = tokens(data[base : offsets[hi]], offsets[lo : hi + 1] - base)
                row = np.tile(np.repeat(np.arange(lo, hi, dtype=np.uint64), np.diff(at)), len(STEMS) + 1)
                pairs = np.unique(np.column_stack([row, units(lowered, starts, ends).ravel()]), axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[:, 1].view(np.int64)), pa.array(label[pairs[:, 0].astype(int)])], ["token", "y"]
                )

    sizes = dict(sample.groupBy("y").count().collect())
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return np.zeros(0, np.uint64)
    counts = sample.select("text", "y").mapInArrow(distinct, "token bigint, y int")
    counts = cut(counts.groupBy("token").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")))
    tried = counts.count()
    a, b = F.col("a"), F.col("b")
    even = (a + b) / (toxic + clean)
    term = lambda n, expected: F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    ratio = 2 * (term(a, toxic * even) + term(b, clean * even))
    picked = counts.where((a * clean > 20 * b * toxic) & (ratio > 2 * np.log(max(tried, 2)) + 6)).select("token")
    return np.sort(np.array([r[0] for r in picked.collect()], np.int64).view(np.uint64))


def _windows(sample: DataFrame, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded training windows: around toxic tokens in toxic documents, anywhere in clean ones."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = blocks.bytes_of(batch.column(0))
            label = blocks.ints(batch.column(1))
            out: list[tuple[bytes, bytes]] = []
            for lo, hi in blocks.ranges(offsets):
                base = offsets[lo]
                lowered, starts, ends, at = tokens(data[base : offsets[hi]], offsets[lo : hi + 1] - base)
                slots, whole = features(lowered, starts, ends)
                marked = np.isin(units(lowered, starts, ends), lexicon).any(axis=0)
                for k in range(hi - lo):
                    a, b = at[k], at[k + 1]
                    if a == b:
                        continue
                    if label[lo + k]:
                        middles = np.flatnonzero(marked[a:b])
                    else:
                        middles = np.unique((whole[a:b][:: max(1, (b - a) // WINDOWS)] % np.uint64(b - a)).astype(int))
                    for middle in middles[:WINDOWS]:
                        low = a + max(0, middle - WIDTH // 2)
                        high = min(b, low + WIDTH)
                        y = marked[low:high] & bool(label[lo + k])
                        out.append((slots[low:high].tobytes(), y.astype(np.uint8).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in range(2)], ["slots", "y"])

    rows = sample.select("text", "y").mapInArrow(work, "slots binary, y binary").orderBy("slots", "y").collect()
    slots = np.zeros((len(rows), WIDTH, FEATURES), np.int32)
    label = np.zeros((len(rows), WIDTH), np.uint8)
    length = np.zeros(len(rows), int)
    for i, (s, y) in enumerate(rows):
        length[i] = len(y)
        slots[i, : len(y)] = np.frombuffer(s, np.int32).reshape(-1, FEATURES)
        label[i, : len(y)] = np.frombuffer(y, np.uint8)
    return slots, label, length


def _tag(tagger: Tagger, column: pa.Array) -> tuple[np.ndarray, list[str]]:
    """The largest marginal of each text, and its offending tokens as start:end, comma-joined."""
    data, offsets = blocks.bytes_of(column)
    largest = np.zeros(len(offsets) - 1)
    spans = [""] * (len(offsets) - 1)
    for lo, hi in blocks.ranges(offsets):
        base = offsets[lo]
        part, rows = data[base : offsets[hi]], offsets[lo : hi + 1] - base
        lowered, starts, ends, at = tokens(part, rows)
        slots, _ = features(lowered, starts, ends)
        first = np.zeros(len(starts), bool)
        first[at[:-1][at[:-1] < at[1:]]] = True
        chance = tagger.marginals(slots, first)
        owner = np.repeat(np.arange(lo, hi), np.diff(at))
        np.maximum.at(largest, owner, chance)
        hit = np.flatnonzero(chance >= THRESHOLD)
        if len(hit):
            points = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])  # code points before each byte
            found: dict[int, list[str]] = {}
            for i in hit.tolist():
                zero = points[rows[owner[i] - lo]]
                found.setdefault(owner[i], []).append(f"{points[starts[i]] - zero}:{points[ends[i]] - zero}")
            for row, texts in found.items():
                spans[row] = ",".join(texts)
    return largest, spans


def fit(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, most: int = MAX_DOCS) -> Tagger | None:
    sample, labelled = _sample(docs, labels, label, id_col, text_col, most)
    lexicon = _lexicon(sample)
    if not len(lexicon):
        return None
    tagger = fit_chain(*_windows(sample, lexicon))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_tag(tagger, batch.column(0))[0]), batch.column(1)], ["p", "y"])

    rows = sample.select("text", "y").mapInArrow(work, "p double, y int").collect()
    p = np.clip(np.array([r[0] for r in rows]), 1e-9, 1 - 1e-9)
    y = np.array([r[1] for r in rows])
    x = np.log(p / (1 - p))
    shares = [labelled.get(c, 0) / max(1, (y == c).sum()) for c in (0, 1)]  # documents that a sampled one stands for
    order = np.argsort(x, kind="stable")
    below = np.concatenate([[0], np.cumsum(np.where(y[order] == 1, shares[1], -shares[0]))])
    values = np.concatenate([[x[order[0]] - 1], x[order], [x[order[-1]] + 1]])
    gaps = np.diff(values)
    allowed = np.where(gaps > 0, below, np.inf)
    best = np.flatnonzero(allowed == allowed.min())
    cut_at = best[np.argmax(gaps[best])]  # the widest of equally good gaps
    tagger.shift = -float(values[cut_at] + values[cut_at + 1]) / 2
    return tagger


def scored(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of `docs`: id_col, held_out, score, predicted (1 from THRESHOLD on), spans."""
    tagger = fit(docs, labels, label, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(tagger)  # SLOTS weights

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            if own is None:
                score, spans = np.zeros(batch.num_rows), [""] * batch.num_rows
            else:
                largest, spans = _tag(own, batch.column(1))
                score = own.score(largest)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(spans, pa.string())], ["id", "score", "spans"])

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col)).mapInArrow(work, f"id {kind}, score double, spans string")
    return found.select(
        F.col("id").alias(id_col),
        (fold(F.col("id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "spans",
    )
