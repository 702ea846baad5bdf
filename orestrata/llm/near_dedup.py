"""MinHash near-duplicate detection by DartMinHash (operator 1).

A text is the multiset of its five-word shingles; two texts are linked if the weighted Jaccard similarity of these
multisets (sum of smaller counts over sum of larger ones) is 0.8 or more. Classes are the connected components.

Signatures: each shingle owns a plane of weight x rank, over which darts fall as a Poisson process with one dart per
unit of area, all drawn from hashes of the shingle, so the same for every text. A text sees the darts whose weight
lies below its count of the shingle. A dart names one of `K` coordinates; the earliest dart (smallest rank) of each
coordinate is the signature. The weight axis is split into dyadic regions and the rank axis into cells of area
one, so only cells up to rank t / total weight are opened: about t = K (ln K + 4) darts for a text of any size. Texts that leave a
coordinate empty are thrown again up to twice the rank. Two texts agree in a coordinate with the probability of
their similarity.

Candidates: 24 bands of 5 coordinates (a pair at 0.8 shares a band with probability 0.99993, and 8 on average).
Each text is compared, whole and exactly, with one pivot first, the member of its buckets that meets most others: one pair a
text, whatever the size of a group. Only where a bucket's members then still lie in several components, those outside its
largest one are compared with the members of other components. So no class is lost that the bands can show. Before two texts meet, their sketches do: the
parities of their shingles over 512 bits differ in no more places than the shingles themselves, so a pair whose sketches
differ in more than similarity 0.8 allows is not near, and goes without its texts being read (`may_be_near`). No near pair goes.

Scale: equal texts are merged first by digest, so copies never meet; every join is an equi-join on a digest, band
or id that adaptive execution may split; nothing is collected.

Edge cases: null and empty texts, and texts of blanks only, have no shingles; those with the same string (null counts
as empty) are copies of each other. A text of one to four words is one shingle. Rows that share an id are one
document, linked by any of its texts. Rows without id get the class of their text, and make one row of the result.
An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orestrata.llm import blocks
from orestrata.llm.shared import components, cut

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
K = BANDS * ROWS
ASKS = [1, 4, 32, 512]  # and then 16 times as many in each round
FEW = 100_000
SKETCH = 8  # 64-bit words
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
# Chances of at most 0, 1, 2 ... darts in a cell of area one, as 64-bit thresholds.
_TERMS = np.cumprod(np.concatenate([[np.exp(-1.0)], 1.0 / np.arange(1, 18)]))
_POISSON = (np.minimum(np.cumsum(_TERMS), 1 - 2.0**-53) * 2.0**64).astype(np.uint64)


def _u(n: int) -> np.uint64:
    return np.uint64(n & 0xFFFFFFFFFFFFFFFF)


def _darts(item, row, weight, limit, k):
    """All darts of the items up to the rank limit of their row: cell row * k + coordinate, and rank with fingerprint."""
    cells_of, values = [], []
    low, width, region = 0.0, 1.0, 0
    while True:
        own = np.flatnonzero(weight > low)
        if not len(own):
            break
        cells = np.ceil(limit[row[own]] * width).astype(np.int64)
        at = np.repeat(own, cells)
        cell = np.arange(len(at)) - np.repeat(np.cumsum(cells) - cells, cells)
        seed = blocks.mixed(item[at] + blocks.mixed(cell.astype(np.uint64) * _u(0x9E3779B97F4A7C15) + _u(region)))
        darts = np.searchsorted(_POISSON, seed, "right")
        again = np.repeat(np.arange(len(at)), darts)
        number = np.arange(len(again)) - np.repeat(np.cumsum(darts) - darts, darts)
        draw = blocks.mixed(seed[again] ^ blocks.mixed(number.astype(np.uint64) + _u(0xD1B54A32D192ED03)))
        second = blocks.mixed(draw + _u(0x8CB92BA72F3D8DD7))
        rank = (cell[again] + (draw >> np.uint64(11)) * 2.0**-53) / width
        height = low + (second >> np.uint64(11)) * 2.0**-53 * width
        at = at[again]
        seen = (rank <= limit[row[at]]) & (height < weight[at])
        at, rank, draw, second = at[seen], rank[seen], draw[seen], second[seen]
        third = blocks.mixed(second + _u(0xABC98388FB8FAC03))
        cells_of.append(row[at] * k + (third % np.uint64(k)).astype(np.int64))
        # Ranks are positive, so their bits are in order; the low bits hold the dart's fingerprint.
        values.append((rank.view(np.uint64) & _u(~0xFFFFFF)) | (third >> np.uint64(40)))
        low, width, region = (1.0, 1.0, 1) if region == 0 else (low * 2, width * 2, region + 1)
    return np.concatenate(cells_of) if cells_of else np.zeros(0, np.int64), np.concatenate(values) if values else np.zeros(0, np.uint64)


def signatures(item: np.ndarray, row: np.ndarray, weight: np.ndarray, rows: int, k: int = K) -> np.ndarray:
    """The K earliest darts of each row of a sparse weighted matrix; rows without items stay at the largest value."""
    found = np.full(rows * k, _NONE)
    total = np.bincount(row, weight, rows)
    limit = k * (np.log(k) + 4) / np.maximum(total, 1e-300)
    open_rows = total > 0
    while open_rows.any():
        own = open_rows[row]
        at, value = _darts(item[own], row[own], weight[own], limit, k)
        np.minimum.at(found, at, value)
        open_rows = open_rows & (found.reshape(rows, k) == _NONE).any(axis=1)
        limit = limit * 2
    return found.reshape(rows, k)


def _counted(data, offsets, words=WORDS):
    """Distinct shingles of each row with their counts: hash, row, count."""
    starts, ends, at = blocks.words_of(data, offsets)
    item, row = blocks.shingles(blocks.hashes(data, starts, ends), at, words)
    key = (row.astype(np.uint64) << np.uint64(48)) | (item >> np.uint64(16))
    key, counts = np.unique(key, return_counts=True)
    return key, (key >> np.uint64(48)).astype(np.int64), counts.astype(np.float64)


def sketches(item: np.ndarray, row: np.ndarray, size: np.ndarray, words: int) -> pa.Array:
    """A struct for each row: how many items it has at most, and the parities of how often they fall on each of 64 * `words` bits.

    `item` are mixed hashes of the items of a set, each once.
    """
    bits = 64 * words
    at = row * bits + (item % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(at, minlength=len(size) * bits) & 1).astype(bool).reshape(len(size), bits)
    packed = np.ascontiguousarray(np.packbits(odd, axis=1)).view(np.int64)
    columns = [pa.array(size.astype(np.int64)), *[pa.array(np.ascontiguousarray(packed[:, k])) for k in range(words)]]
    return pa.StructArray.from_arrays(columns, ["size", *[f"w{k}" for k in range(words)]])


def sketch_type(words: int) -> str:
    return f"struct<size:bigint,{','.join(f'w{k}:bigint' for k in range(words))}>"


def may_be_near(one: str, two: str, words: int, similarity: float) -> Column:
    """False only for pairs below the similarity.

    Of two sets, Jaccard similarity s leaves (1 - s) / (1 + s) of their sizes' sum to items in one of them only; each such item changes
    one parity, so at least as many items as parities differ.
    """
    counts = [F.bit_count(F.col(f"{one}.w{k}").bitwiseXOR(F.col(f"{two}.w{k}"))) for k in range(words)]
    differ = reduce(Column.__add__, counts, F.lit(0))
    return differ <= (F.col(f"{one}.size") + F.col(f"{two}.size")) * ((1 - similarity) / (1 + similarity)) + 1e-6


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = blocks.bytes_of(batch.column(2))
        parts, sketched = [], []
        for lo, hi in blocks.ranges(offsets):
            key, row, count = _counted(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            sketched.append(_sketch(key, row, count, hi - lo))
            signature = signatures(key << np.uint64(16), row, count, hi - lo)
            bands = (signature.reshape(hi - lo, BANDS, ROWS) * blocks.FACTORS[:ROWS]).sum(axis=2, dtype=np.uint64)
            bands = blocks.mixed(bands + np.arange(BANDS, dtype=np.uint64) * blocks.FACTORS[9]).view(np.int64)
            none = signature[:, 0] == _NONE
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.where(none, 0, BANDS))]), pa.int32()),
                pa.array(bands[~none].ravel(), pa.int64()),
            )
            parts.append(lists)
        if not parts:
            parts, sketched = [pa.array([], pa.list_(pa.int64()))], [_sketch(*_counted(data, offsets), 0)]
        columns = [batch.column(0), batch.column(1), pa.concat_arrays(parts), pa.concat_arrays(sketched)]
        yield pa.RecordBatch.from_arrays(columns, ["id", "digest", "bands", "sketch"])


def _sketch(key: np.ndarray, row: np.ndarray, count: np.ndarray, rows: int) -> pa.Array:
    """Of multisets: the second, third ... occurrence of a shingle is an item of its own."""
    times = count.astype(np.int64)
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    item = blocks.mixed(np.repeat(key << np.uint64(16), times) + nth.astype(np.uint64) * blocks.FACTORS[11])
    return sketches(item, np.repeat(row, times), np.bincount(row, count, rows), SKETCH)


def _similarities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact weighted Jaccard similarity of the two texts of each row."""
    for batch in batches:
        one, one_at = blocks.bytes_of(batch.column(2))
        two, two_at = blocks.bytes_of(batch.column(3))
        out = []
        for lo, hi in blocks.ranges(one_at + two_at):
            n = hi - lo
            key1, row1, count1 = _counted(one[one_at[lo] : one_at[hi]], one_at[lo : hi + 1] - one_at[lo])
            key2, row2, count2 = _counted(two[two_at[lo] : two_at[hi]], two_at[lo : hi + 1] - two_at[lo])
            _, i, j = np.intersect1d(key1, key2, assume_unique=True, return_indices=True)
            both = np.bincount(row1[i], np.minimum(count1[i], count2[j]), n)
            total = np.bincount(row1, count1, n) + np.bincount(row2, count2, n)
            out.append(both / np.maximum(total - both, 1))
        found = np.concatenate(out) if out else np.zeros(0)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], ["a", "b", "similarity"])


def texts_for(pairs: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """`texts` that pairs (a, b) name by `key`, so that the others are not shuffled; all, if pairs are many. `pairs` are counted first."""
    if pairs.count() > FEW:
        return texts
    return texts.join(F.broadcast(pairs.select(F.explode(F.array("a", "b")).alias(key))), key, "left_semi")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, similarity) of distinct pairs a < b; `texts` has (id, text)."""
    texts = texts_for(pairs, texts, "id")
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_similarities, "a bigint, b bigint, similarity double")


def star_pairs(shared: DataFrame) -> DataFrame:
    """At most one pair (a < b) for each member; `shared` has (band, rep, n).

    A bucket's pivot is the member that meets most others over all its buckets: in a group of copies of one text, that text.
    Of the pivots of its buckets a member meets the one that meets most.
    """
    fame = shared.groupBy("rep").agg(F.sum("n").alias("fame"))
    tops = shared.join(fame, "rep").groupBy("band").agg(F.max(F.struct("fame", (-F.col("rep")).alias("last"))).alias("top"))
    best = shared.join(tops, "band").groupBy("rep").agg(F.max("top").alias("top"))
    pairs = best.select("rep", (-F.col("top.last")).alias("pivot")).where("rep <> pivot")
    return pairs.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()


def linked(
    shared: DataFrame,
    verified: Callable[[DataFrame], DataFrame],
    sketched: DataFrame | None = None,
    words: int = 0,
    similarity: float = SIMILARITY,
) -> tuple[DataFrame, DataFrame]:
    """(links, roots): the pairs (a, b) found near, and a row (node, root) for each of their nodes.

    `shared` has (band, rep, n); `verified` keeps the near ones of pairs; `sketched`, if given, has (rep, sketch) of `words` words for
    each text of a member, and pairs that sketches put below `similarity` are not verified. After the pivots, buckets whose members
    lie in more than one component go on: members outside the bucket's largest component meet all members of other components, at
    first ASKS[0] of them in each bucket, then more in each round, until one round has asked all that were left. So of
    any two members of a bucket that end in different classes, the similarity was computed, or their sketches rule it out.
    """
    pairs = cut(star_pairs(shared))
    if sketched is None:
        sketched = shared.select("rep", F.struct(F.lit(0).alias("size")).alias("sketch")).distinct()
    both = pairs.join(sketched.toDF("a", "one"), "a").join(sketched.toDF("b", "two"), "b")
    links = cut(verified(cut(both.where(may_be_near("one", "two", words, similarity)).select("a", "b").distinct())))
    roots = cut(components(links, "a", "b"))
    rest = cut(_apart(shared.select("band", "rep"), roots))
    for turn in count():
        most = ASKS[turn] if turn < len(ASKS) else ASKS[-1] * 16 ** (turn + 1 - len(ASKS))
        place = F.dense_rank().over(Window.partitionBy("band").orderBy("rep"))
        asks = rest.where("part <> main").withColumn("place", place).where(F.col("place") <= most + 1)
        asks = cut(asks.select("band", "place", F.col("rep").alias("ask"), F.col("part").alias("ask_part")))
        last = asks.agg(F.max("place")).first()[0]
        if last is None:
            return links, roots
        apart = (F.col("part") != F.col("ask_part")) & may_be_near("sketch", "ask_sketch", words, similarity)
        asks = asks.where(F.col("place") <= most).join(sketched.toDF("ask", "ask_sketch"), "ask")
        new = rest.join(sketched, "rep").join(asks, "band").where(apart)
        new = new.select(F.least("rep", "ask").alias("a"), F.greatest("rep", "ask").alias("b")).distinct()
        new = cut(new.join(pairs, ["a", "b"], "left_anti"))
        found = cut(verified(new))
        links = links.unionByName(found)
        roots = cut(components(roots.toDF("a", "b").unionByName(found), "a", "b"))
        if last <= most:
            return links, roots
        pairs = pairs.unionByName(new)
        rest = cut(_apart(rest.drop("part", "main"), roots))


def _apart(rest: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of buckets that lie in several components, each with its component `part` and the bucket's largest one, `main`."""
    rest = rest.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("part", F.coalesce("root", "rep")).drop("root")
    parts = rest.groupBy("band", "part").agg(F.count("*").alias("n"))
    parts = parts.groupBy("band").agg(F.max_by("part", F.struct("n", "part")).alias("main"), F.count("*").alias("parts"))
    return rest.join(parts.where("parts > 1").select("band", "main"), "band")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """A row for each id: (id_col, class_id, links, kept).

    class_id is the smallest id of the document's class, links the number of other distinct texts it was linked to
    when its class was found (a lower bound of its neighbours), kept whether it is the one document of the class
    that stays.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = rows.select("id", F.unhex(F.md5("text")).alias("digest"), "text")
    banded = keyed.mapInArrow(_band_keys, f"id bigint, digest binary, bands array<bigint>, sketch {sketch_type(SKETCH)}")
    members = cut(banded)
    texts_of = members.groupBy("digest").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"))
    texts_of = texts_of.where("rep is not null")
    named = cut(members.select("id", "digest").join(texts_of.select("digest", "rep"), "digest", "left").select("id", "rep"))
    buckets = texts_of.select("rep", F.explode("bands").alias("band"))
    sizes = buckets.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    shared = cut(buckets.join(sizes, "band").select("band", "rep", "n"))
    needed = shared.select(F.col("rep").alias("id")).distinct()
    texts = rows.join(needed, "id", "left_semi").withColumn("digest", F.md5("text"))
    texts = cut(texts.dropDuplicates(["id", "digest"]).select("id", "text"))
    # An id with several texts has several sketches.
    sketched = cut(members.join(needed, "id", "left_semi").select(F.col("id").alias("rep"), "sketch").distinct())

    def verified(pairs: DataFrame) -> DataFrame:
        return _verified(pairs, texts).where(F.col("similarity") >= similarity).select("a", "b").distinct()

    links, roots = linked(shared, verified, sketched, SKETCH, similarity)

    ends = links.select(F.col("a").alias("rep"), "b").unionByName(links.select(F.col("b").alias("rep"), F.col("a").alias("b")))
    degree = ends.groupBy("rep").agg(F.count("*").alias("links"))
    labelled = named.join(roots.withColumnRenamed("node", "rep"), "rep", "left").join(degree, "rep", "left")
    out = labelled.groupBy("id").agg(
        F.min(F.coalesce("root", "rep")).alias("class_id"), F.max(F.coalesce("links", F.lit(0))).alias("links")
    )
    kept = F.coalesce(F.col("id") == F.col("class_id"), F.lit(True))
    return out.select(F.col("id").alias(id_col), "class_id", "links", kept.alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose document stays: one of each class. Rows without id stay."""
    gone = near_duplicates(docs, id_col, text_col).where("not kept").select(F.col(id_col).alias("__gone"))
    return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")
