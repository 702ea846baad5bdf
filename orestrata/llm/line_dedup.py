"""Fuzzy line deduplication by MinHash (operator 8).

A line (between line breaks, outer blanks off, with at least one word) is the set of its runs of `SHINGLE` characters; a
shorter line is one run. Two lines are linked if the Jaccard similarity of these sets is 0.8 or more; classes are the
connected components; the first line of a class, by document id and place, is kept and all others are removed.

Signatures have 40 minima of multiplied 32-bit hashes, cut into 10 bands of 4 (a pair at 0.8 shares a band with
probability 0.995, at 0.9 with 0.99997). A line is compared with one pivot of its buckets, and where a bucket then lies in several
components this goes on until any two members of different classes were compared, see `near_dedup.linked`. Candidates
whose sketches of 256 parities can't belong to near lines go (`near_dedup.may_be_near`), all others are verified exactly from their
characters.

Scale: equal lines have one 64-bit hash and are one node, so copies cost a row each and never meet. Band keys are merged where they
arise; texts are read again only for candidates, through a filter of bounded size. Every join is an equi-join that
adaptive execution may split; the union-find is distributed; nothing is collected but the filter.

Edge cases: a null or empty text, and lines without words, have no lines here; such lines stay in the cleaned text as they are. Rows
that share an id are one document: their lines at the same place stay or go together if equal. Rows without id are not
searched, and are kept whole. An empty table gives an empty result. A document that loses every line stays, with an empty
text. Other columns are kept by `cleaned`; a column `n_chars`, if there is one, follows the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestrata.llm import blocks
from orestrata.llm.near_dedup import linked, sketch_type, sketches, texts_for
from orestrata.llm.shared import cut, key_filter, may_hold

SHINGLE = 8
SKETCH = 4  # 64-bit words
SIMILARITY = 0.8
BANDS, ROWS = 10, 4
K = BANDS * ROWS
_FACTORS = (blocks.FACTORS[:K] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_TERMS = (blocks.mixed(blocks.FACTORS[:K]) >> np.uint64(32)).astype(np.uint32)
_BLANKS = np.array([9, 10, 11, 12, 13, 32])


class Lines:
    """The lines of a block of texts, in code points."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        breaks = np.flatnonzero(self.points == 10)
        starts = np.concatenate([at[:-1], breaks + 1])
        ends = np.concatenate([breaks, at[1:]])
        row = np.concatenate([np.arange(len(at) - 1), np.searchsorted(at, breaks, "right") - 1])
        order = np.lexsort((starts, row))
        starts, row = starts[order], row[order]
        # Row by row, the breaks of a text end all lines but its last one.
        row_of_end = np.concatenate([np.searchsorted(at, breaks, "right") - 1, np.arange(len(at) - 1)])
        ends = ends[np.lexsort((ends, row_of_end))]
        number = np.arange(len(row)) - np.searchsorted(row, row)
        solid = np.flatnonzero(~np.isin(self.points, _BLANKS))
        first, last = np.searchsorted(solid, starts), np.searchsorted(solid, ends) - 1
        full = np.flatnonzero(last >= first)
        self.row, self.number = row[full], number[full]
        self.starts, self.ends = solid[first[full]], solid[last[full]] + 1

    def hashes(self) -> np.ndarray:
        raw = self.points.tobytes()
        return np.array(
            [
                int.from_bytes(hashlib.blake2b(raw[a * 4 : b * 4], digest_size=8).digest(), "little", signed=True)
                for a, b in zip(self.starts.tolist(), self.ends.tolist())
            ],
            np.int64,
        )

    def text(self, k: int) -> str:
        return self.points[self.starts[k] : self.ends[k]].tobytes().decode("utf-32-le")

    def shingles(self, some: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """64-bit hashes of the runs of each line (or of some), and the offsets of lines into them."""
        starts, ends = self.starts[some], self.ends[some]
        size = ends - starts
        runs = np.maximum(size - SHINGLE + 1, 1)
        offsets = np.concatenate([[0], np.cumsum(runs)])
        at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], runs)
        points = self.points.astype(np.uint64) + np.uint64(1)
        points = np.concatenate([points, np.zeros(SHINGLE, np.uint64)])
        total = np.zeros(len(points), np.uint64)
        for k in range(SHINGLE):
            total[: len(points) - k] += points[k:] * blocks.FACTORS[k]
        found = total[at]
        for line in np.flatnonzero(size < SHINGLE):  # nothing of the next line may count
            part = points[starts[line] : ends[line]]
            found[offsets[line]] = (part * blocks.FACTORS[: len(part)]).sum(dtype=np.uint64)
        return blocks.mixed(found), offsets

    def sketches(self, some: np.ndarray) -> pa.Array:
        """Sketches of some lines. A run that a line has again counts once in the parities, so `size` may be too large, which is safe."""
        runs, offsets = self.shingles(some)
        count = np.diff(offsets)
        row = np.repeat(np.arange(len(count)), count)
        key = np.unique((row.astype(np.uint64) << np.uint64(40)) | (runs >> np.uint64(24)))
        return sketches(blocks.mixed(key << np.uint64(24)), (key >> np.uint64(40)).astype(np.int64), count, SKETCH)

    def bands(self) -> np.ndarray:
        """BANDS keys for each line."""
        runs, offsets = self.shingles()
        runs = (runs >> np.uint64(32)).astype(np.uint32)
        keys = np.empty((len(self.row), BANDS), np.uint64)
        for band in range(BANDS):
            key = np.full(len(self.row), blocks.FACTORS[band] ^ np.uint64(band), np.uint64)
            for j in range(band * ROWS, band * ROWS + ROWS):
                low = np.minimum.reduceat(runs * _FACTORS[j] + _TERMS[j], offsets[:-1]) if len(self.row) else key
                key = blocks.mixed(key + low.astype(np.uint64) * blocks.FACTORS[10])
            keys[:, band] = key
        return keys.view(np.int64)


def _each(column: pa.Array) -> Iterator[tuple[int, Lines]]:
    data, offsets = blocks.bytes_of(column)
    for lo, hi in blocks.ranges(offsets):
        yield lo, Lines(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, lines in _each(batch.column(1)):
            keys = lines.bands()
            sizes = pa.array(np.arange(len(keys) + 1) * BANDS, pa.int32())
            columns = [
                batch.column(0).take(pa.array(lines.row + lo)),
                pa.array(lines.number, pa.int32()),
                pa.array(lines.hashes()),
                pa.ListArray.from_arrays(sizes, pa.array(keys.ravel())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "line", "hash", "bands"])


@lru_cache(2048)
def _runs(line: str) -> frozenset[str]:
    return frozenset([line[i : i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))])


def _similarities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact Jaccard similarity of the two lines of each row. Pivots come again and again, so their sets are kept."""
    for batch in batches:
        out = []
        for one, two in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            a, b = _runs(one), _runs(two)
            common = len(a & b)
            out.append(common / (len(a) + len(b) - common))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], ["a", "b", "similarity"])


def classified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """A row for each line: id_col, line (from 0), class_id, first_id, first_line, kept."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    lines = cut(rows.mapInArrow(_lines, "id bigint, line int, hash bigint, bands array<bigint>"))
    buckets = lines.select("hash", F.explode("bands").alias("band"))
    mixed = buckets.groupBy("band").agg(F.min("hash").alias("low"), F.max("hash").alias("high")).where("low < high")
    shared = buckets.join(mixed.select("band"), "band").distinct()
    shared = cut(shared.select("band", F.col("hash").alias("rep")))
    sizes = shared.groupBy("band").agg(F.count("*").alias("n"))
    needed = cut(shared.select(F.col("rep").alias("hash")).distinct())
    held = docs.sparkSession.sparkContext.broadcast(key_filter(needed, "hash"))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, found in _each(batch.column(0)):
                hashes = found.hashes()
                hit = np.flatnonzero(may_hold(held.value, hashes))
                _, one = np.unique(hashes[hit], return_index=True)
                texts = pa.array([found.text(k) for k in hit[one].tolist()], pa.string())
                columns = [pa.array(hashes[hit[one]]), texts, found.sketches(hit[one])]
                yield pa.RecordBatch.from_arrays(columns, ["hash", "text", "sketch"])

    texts = rows.select("text").mapInArrow(again, f"hash bigint, text string, sketch {sketch_type(SKETCH)}")
    texts = texts.join(needed, "hash", "left_semi").groupBy("hash").agg(F.max(F.struct("text", "sketch")).alias("of"))
    texts = cut(texts.select("hash", "of.text", "of.sketch"))

    def verified(pairs: DataFrame) -> DataFrame:
        own = texts_for(pairs, texts, "hash")
        left = own.select(F.col("hash").alias("a"), F.col("text").alias("text_a"))
        right = own.select(F.col("hash").alias("b"), F.col("text").alias("text_b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
        near = both.mapInArrow(_similarities, "a bigint, b bigint, similarity double")
        return near.where(F.col("similarity") >= similarity).select("a", "b")

    sketched = texts.select(F.col("hash").alias("rep"), "sketch")
    _, roots = linked(shared.join(sizes, "band"), verified, sketched, SKETCH, similarity)
    roots = roots.withColumnRenamed("node", "hash")

    classed = lines.select("id", "line", "hash").join(roots, "hash", "left")
    classed = classed.select("id", "line", F.coalesce("root", "hash").alias("class_id"))
    firsts = classed.groupBy("class_id").agg(F.min(F.struct("id", "line")).alias("first"))
    found = classed.join(firsts, "class_id")
    return found.select(
        F.col("id").alias(id_col),
        "line",
        "class_id",
        F.col("first.id").alias("first_id"),
        F.col("first.line").alias("first_line"),
        ((F.col("id") == F.col("first.id")) & (F.col("line") == F.col("first.line"))).alias("kept"),
    )


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the removed lines taken out of the texts, all columns and rows otherwise as they are."""
    gone = classified(docs, id_col, text_col).where("not kept").groupBy(id_col).agg(F.sort_array(F.collect_set("line")).alias("__lines"))
    gone = gone.withColumnRenamed(id_col, "__id")

    @F.pandas_udf("string")
    def without(texts: pd.Series, lines: pd.Series) -> pd.Series:
        def one(text: str | None, removed) -> str | None:
            drop = set(removed)
            if not drop or text is None:
                return text
            return "\n".join([x for i, x in enumerate(text.split("\n")) if i not in drop])

        return pd.Series([one(t, r) for t, r in zip(texts, lines)], dtype=object)

    joined = docs.join(gone, docs[id_col] == gone["__id"], "left")
    text = F.when(F.col("__lines").isNull(), F.col(text_col)).otherwise(without(F.col(text_col), F.coalesce("__lines", F.array())))
    joined = joined.withColumn(text_col, text)
    if "n_chars" in docs.columns:
        size = F.length(text_col).cast(docs.schema["n_chars"].dataType)
        joined = joined.withColumn("n_chars", F.when(F.col("__lines").isNull(), F.col("n_chars")).otherwise(size))
    return joined.select(*docs.columns)
