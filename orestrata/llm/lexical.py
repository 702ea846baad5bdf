"""Ranked lexical search over norm buckets, exact (operator 13).

Every item's terms ask all documents. A document is a vector of impacts, one coordinate for each term of the items that it holds;
an item is a vector of how often it has each term. Weights and impacts are whole numbers, so scores are exact sums.

1. Terms of all documents are counted once: how many each document has, which of the items' terms, how often.
2. Documents are ordered by the length of their weighted impact vector, dealt to tasks by ranges of it (equal lengths are spread) and
   cut into buckets of `BUCKET` documents.
3. The longest vectors are searched first, wherever they are. An item's k-th best score there is a bound for all buckets; each task
   raises it by what it finds.
4. A bucket is skipped for an item if the item's length times the longest vector (Cauchy-Schwarz), or the sum of the bucket's
   largest coordinates, stays below the bound. Inside, the item's terms are ordered by what they can give. Only documents
   that hold one of the leading terms, without which the bound is out of reach, are looked at, and only while what they have
   plus the rest (by coordinates and by length) reaches the bound. Survivors are scored exactly in 64-bit integers.
5. Each task hands over its k best of each item; a window takes the k best of these.

Bounds are floating point with a margin far above their error, and scores equal to the bound are kept, so nothing is lost.
Items are taken in blocks of about `BLOCK` different texts, each searched over all documents; a block's terms and weights are broadcast,
and nothing that grows with the documents is.

Edge cases: a null or empty text has no terms and is not counted in N; an item without terms, or whose terms occur nowhere or
everywhere (weight 0), has no rows; repeated rows of documents or items are rows of their own; equal scores are ordered by id, nulls
last; very long texts are split in pieces at separators; empty tables give an empty result; other columns are never read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orestrata.llm.shared import cut

K = 10
BLOCK = 1024
BUCKET = 2048
LEADERS = 4096
PIECE = 1 << 20
MARGIN = 1 + 1e-9

# Terms are runs of letters, digits and bytes from 0x80 on; A-Z are lower-cased. All else becomes a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in pieces of about PIECE bytes."""
    raw = raw.translate(_FOLD)
    lo = 0
    while len(raw) - lo > PIECE:
        hi = raw.find(b" ", lo + PIECE)
        if hi < 0:
            break
        yield raw[lo:hi].split()
        lo = hi
    yield raw[lo:].split()


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def lengths_of(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """m of documents of n terms; sums beyond 64 bits are taken as Python's integers."""
    if 75 * int(n.max(initial=0)) * documents >= 1 << 63:
        return np.array([25 + 75 * int(x) * documents // total for x in n], np.int64)
    return 25 + 75 * n * documents // total


class Items:
    """The items of a block as sparse rows over its terms."""

    def __init__(self, texts: list[str]) -> None:
        counts = [Counter(t for part in terms(text.encode()) for t in part) for text in texts]
        self.vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
        self.edges = np.concatenate([[0], np.cumsum([len(c) for c in counts])]).astype(np.int64)
        self.terms = np.array([self.vocabulary[t] for c in counts for t in c], np.int64)
        self.times = np.array([n for c in counts for n in c.values()], np.int64)

    def __len__(self) -> int:
        return len(self.edges) - 1


class Bucket:
    """Documents of neighbouring lengths: their sparse vectors by document and by term."""

    def __init__(self, norms: np.ndarray, edges: np.ndarray, terms: np.ndarray, values: np.ndarray, size: int) -> None:
        self.norms, self.edges, self.terms, self.values = norms, edges, terms, values
        order = np.argsort(terms, kind="stable")
        self.rows = np.repeat(np.arange(len(norms)), np.diff(edges))[order]
        self.by_term = values[order]
        self.places = np.searchsorted(terms[order], np.arange(size + 1))
        self.most = np.zeros(size, np.int64)
        held = np.flatnonzero(np.diff(self.places))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.by_term, self.places[held])

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact products of some documents with a dense query."""
        sizes = self.edges[rows + 1] - self.edges[rows]
        ends = np.cumsum(sizes)
        at = np.repeat(self.edges[rows] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        total = np.concatenate([[0], np.cumsum(query[self.terms[at]] * self.values[at])])
        return total[ends] - total[ends - sizes]

    def search(self, own: np.ndarray, times: np.ndarray, bound: int, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose score is above 0 and at least `bound`, and their scores. `query` is a dense vector of zeros to work in."""
        gain = times * self.most[own]
        order = np.argsort(-gain, kind="stable")
        own, times, gain = own[order], times[order], gain[order]
        rest = np.concatenate([np.cumsum(gain[::-1])[::-1], [0]])  # what terms from here on can give
        least = max(bound, 1)
        leading = int(np.argmax(rest < least))
        partial = np.zeros(len(self.norms), np.int64)
        for t, n in zip(own[:leading], times[:leading]):
            lo, hi = self.places[t], self.places[t + 1]
            partial[self.rows[lo:hi]] += n * self.by_term[lo:hi]
        met = np.flatnonzero(partial)
        length = math.sqrt(float((times[leading:] ** 2).sum()))
        reach = partial[met] + np.minimum(float(rest[leading]), length * self.norms[met] * MARGIN)
        met = met[reach * MARGIN >= least]
        query[own] = times
        found = self.scores(met, query)
        query[own] = 0
        good = found >= least
        return met[good], found[good]


def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """item_col, rank, id_col, score: for each row of `items` the k documents of highest score above 0."""
    asked = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("asked"))
    texts = asked.where("asked is not null").select("asked").distinct()
    blocks = max(1, -(-texts.count() // BLOCK))
    corpus = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = None
    for number in range(blocks):
        block = texts.where(F.pmod(F.xxhash64("asked"), F.lit(blocks)) == number)
        part = _search(corpus, sorted(r.asked for r in block.collect()), k)
        found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("asked").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return asked.join(top, "asked").select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _search(corpus: DataFrame, texts: list[str], k: int) -> DataFrame:
    """The best documents of each task for each text: asked, id, score."""
    spark = corpus.sparkSession
    asked = Items(texts)
    kind = corpus.schema["id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(asked.vocabulary)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.get
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                sizes, held, times = [], [], []
                for raw in part.column(1).cast(pa.binary()):
                    n, counts = 0, Counter()
                    for words in terms(raw.as_py() or b""):
                        n += len(words)
                        counts.update(map(known, words))
                    counts.pop(None, None)
                    sizes.append(n)
                    held.append(np.fromiter(counts.keys(), np.int32, len(counts)).tobytes())
                    times.append(np.fromiter(counts.values(), np.int32, len(counts)).tobytes())
                columns = [part.column(0), pa.array(sizes, pa.int64()), pa.array(held, pa.binary()), pa.array(times, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "times"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = np.zeros(len(shared.value), np.int64)
        documents = total = 0
        for batch in batches:
            n = batch.column(0).to_numpy()
            documents, total = documents + int((n > 0).sum()), total + int(n.sum())
            for held, _ in _rows(batch.column(1)):
                frequency += np.bincount(held, minlength=len(frequency))
        at = np.flatnonzero(frequency)
        values = np.concatenate([[documents, total], frequency[at]]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -2], at])), pa.array(values)], ["term", "n"])

    counted = cut(corpus.mapInArrow(scan, f"id {kind}, n bigint, terms binary, times binary"))
    # One row for each term of the block.
    sums = counted.select("n", "terms").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    sums = {r.term: r.n for r in sums.collect()}
    documents, total = sums.pop(-1, 0), sums.pop(-2, 0)
    weights = np.zeros(len(asked.vocabulary), np.int64)
    for term, n in sums.items():
        weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1)))
    facts = spark.sparkContext.broadcast((asked, weights, documents, total))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, weights, documents, total = facts.value
        for batch in batches:
            n = batch.column(1).to_numpy()
            m = lengths_of(n, documents, max(total, 1))
            at = 0
            for (held, edges), (times, _) in zip(_rows(batch.column(2)), _rows(batch.column(3))):
                rows = len(edges) - 1
                values = weights[held] * impacts(times.astype(np.int64), np.repeat(m[at : at + rows], np.diff(edges)))
                squares = np.concatenate([[0], np.cumsum(values.astype(float) ** 2)])
                cuts = zip(edges[:-1].tolist(), edges[1:].tolist())
                columns = [
                    batch.column(0).slice(at, rows),
                    pa.array(np.sqrt(squares[edges[1:]] - squares[edges[:-1]])),
                    batch.column(2).slice(at, rows),
                    pa.array([values[a:b].tobytes() for a, b in cuts], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "norm", "terms", "impacts"])
                at += rows

    weighed = counted.mapInArrow(weigh, f"id {kind}, norm double, terms binary, impacts binary").where("norm > 0")
    weighed = cut(weighed)

    def search(start):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked, weights, _, _ = facts.value
            floor = start.value if start is not None else {}
            size = len(asked)
            bound = np.array([floor.get(i, 0) for i in range(size)], np.int64)
            best: list[list[tuple]] = [[] for _ in range(size)]
            owner = np.repeat(np.arange(size), np.diff(asked.edges))
            length = np.sqrt(np.bincount(owner, asked.times.astype(float) ** 2, size))
            query = np.zeros(len(weights), np.int64)
            id_type = None
            for batch in batches:
                id_type = batch.schema.field(0).type
                for lo in range(0, batch.num_rows, BUCKET):
                    part = batch.slice(lo, BUCKET)
                    ((held, edges),) = _rows(part.column(2), BUCKET)
                    ((values, _),) = _rows(part.column(3), BUCKET, np.int64)
                    bucket = Bucket(part.column(1).to_numpy(), edges, held, values, len(weights))
                    most = np.bincount(owner, asked.times * bucket.most[asked.terms], size)
                    reach = np.minimum(most, length * bucket.norms.max() * MARGIN) * MARGIN
                    place = None
                    for i in np.flatnonzero((reach >= bound) & (reach > 0)):
                        own = slice(asked.edges[i], asked.edges[i + 1])
                        rows, scores = bucket.search(asked.terms[own], asked.times[own], int(bound[i]), query)
                        if not len(rows):
                            continue
                        if place is None:  # order of the bucket's ids, nulls last
                            place = np.empty(part.num_rows, np.int64)
                            place[pc.sort_indices(part.column(0), null_placement="at_end").to_numpy()] = np.arange(part.num_rows)
                        first = np.lexsort((place[rows], -scores))[:k]
                        new = [(-int(scores[x]), part.column(0)[int(rows[x])].as_py()) for x in first]
                        best[i] = sorted(best[i] + new, key=lambda x: (x[0], x[1] is None, x[1] if x[1] is not None else 0))[:k]
                        if len(best[i]) == k:
                            bound[i] = max(bound[i], -best[i][-1][0])
            rows = [(i, id_, -score) for i, own in enumerate(best) for score, id_ in own]
            if rows:
                numbers, ids, scores = zip(*rows)
                columns = [pa.array(numbers, pa.int32()), pa.array(ids, id_type), pa.array(scores, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["number", "id", "score"])

        return work

    result = f"number int, id {kind}, score bigint"
    # The longest vectors, a few more than LEADERS: they are found by a quantile, and stay where they are.
    share = max(0.0, 1 - LEADERS / max(documents, 1))
    edge = weighed.agg(F.percentile_approx("norm", share, 10_000)).first()[0]
    leaders = weighed.where(F.col("norm") >= F.lit(edge if edge is not None else 0.0)).mapInArrow(search(None), result)
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    start = leaders.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).collect()
    start = spark.sparkContext.broadcast({r.number: r.score for r in start})
    # Equal vectors are spread by a number of their own, stable because their rows are stored.
    dealt = weighed.repartitionByRange(F.desc("norm"), F.rand(13)).sortWithinPartitions(F.desc("norm"))
    names = spark.createDataFrame(list(enumerate(texts)), "number int, asked string")
    found = dealt.mapInArrow(search(start), result)
    return found.join(F.broadcast(names), "number").drop("number")


def _rows(column: pa.Array, rows: int = 1024, kind: type = np.int32) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of some rows at a time, and the n + 1 offsets of the rows."""
    for lo in range(0, len(column), rows):
        parts = [np.frombuffer(x.as_buffer(), kind) for x in column.slice(lo, rows)]
        yield np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
