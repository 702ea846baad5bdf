"""Repeated passages by sparse suffix arrays (operator 9).

A passage is a run of `PASSAGE` (50) words or more that occurs in two places, in one document or several. Texts are
suffixes of word hashes. Only suffixes at minimiser positions are kept: in every run of 50 words, the place whose
`GRAM` (11) words have the smallest hash, the first on ties. Equal runs choose equal places, so every repeated passage holds an
anchor, and its 50 words lie within 39 words before and 50 words after it.

1. Anchors with their gram and the hash of those 89 words are grouped by gram. A gram that occurs once repeats nothing.
2. Anchors whose 89 words are found at two places are wholly repeated; that is most of any copied text.
3. What differs, at the edges of passages, is sorted: suffixes by gram, the words after the anchor, then those before it, and once more with
   before and after exchanged. Each suffix is compared with its `NEIGHBOURS` next ones in the order, the match extended left and right; a match
   of 50 words or more is a repeated passage. The order is cut into ranges, one a task; where ranges
   meet, their first and last suffixes are compared in a step of their own, a few rows for each range.
4. A gram of more contexts than a suffix has neighbours may hold matches between others. The next suffix in an order has the longest
   match on that order's side, so the two orders bound the windows of 50 words that a suffix can share with any other. Where
   matches leave such a window of a suffix open, the gram's suffixes give a hash for each window within their bounds, and a
   window found in two contexts is repeated. So nothing rests on which suffixes are neighbours.

Scale: anchors are about 1 in 20 words, grouped by hash; contexts are made, in a second reading of the texts, only for differing
ones, found through a filter of bounded size. Equal contexts are one row, so copies never meet, and a hot gram is split by
its context, since ranges are over all of the sort key.

Edge cases: null, empty and short texts (fewer than 50 words) have no passages. Rows that share an id are one document; equal places
of it in equal rows are one place. Rows without id are not searched, and have a row of zeros. An empty table gives an
empty result. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestrata.llm import blocks
from orestrata.llm.shared import cut, hot_join, key_filter, may_hold

PASSAGE = 50
GRAM = 11
BEFORE = PASSAGE - GRAM  # 39: an anchor's largest distance from the start of a run
AFTER = PASSAGE
NEIGHBOURS = 3


def anchors(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimiser positions of all runs of PASSAGE words within rows, and their gram hashes. `words` are hashes."""
    n = len(words) - GRAM + 1
    if n < BEFORE + 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = np.zeros(n, np.uint64)
    for k in range(GRAM):
        grams += words[k : n + k] * blocks.FACTORS[k]
    grams = blocks.mixed(grams)
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(words))
    runs = np.flatnonzero(left >= PASSAGE)  # starts of runs; a run has BEFORE + 1 grams
    if not len(runs):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    windows = np.lib.stride_tricks.sliding_window_view(grams, BEFORE + 1)
    best = np.concatenate([windows[part].argmin(axis=1) for part in np.array_split(runs, -(-len(runs) // 8192))])
    places = np.unique(runs + best)
    return places, grams[places]


def _context_hashes(words: np.ndarray, low: np.ndarray, high: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A hash of the words from low to high and of where the place is between them."""
    up, down = blocks.powers(len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=total[1:])
    body = (total[high] - total[low]) * down[low]
    sides = (place - low).astype(np.uint64) * blocks.FACTORS[30] + (high - place).astype(np.uint64) * blocks.FACTORS[31]
    return blocks.mixed(body + blocks.mixed(sides))


class _Texts:
    """Anchors of a block of texts and what surrounds them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        starts, ends, self.at = blocks.words_of(data, offsets)
        self.words = blocks.hashes(data, starts, ends)
        self.place, self.gram = anchors(self.words, self.at)
        self.row = np.searchsorted(self.at, self.place, "right") - 1
        self.low = np.maximum(self.place - BEFORE, self.at[self.row])
        self.high = np.minimum(self.place + AFTER, self.at[self.row + 1])
        self.context = _context_hashes(self.words, self.low, self.high, self.place)


def _each(column: pa.Array) -> Iterator[tuple[int, _Texts]]:
    data, offsets = blocks.bytes_of(column)
    for lo, hi in blocks.ranges(offsets):
        yield lo, _Texts(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, texts in _each(batch.column(1)):
            columns = [
                batch.column(0).take(pa.array(texts.row + lo)),
                pa.array((texts.place - texts.at[texts.row]).astype(np.int32)),
                pa.array((texts.place - texts.low).astype(np.int32)),
                pa.array((texts.high - texts.place).astype(np.int32)),
                pa.array(texts.gram.view(np.int64)),
                pa.array(texts.context.view(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "place", "l", "r", "gram", "context"])


_SUFFIX = "gram bigint, context bigint, before binary, after binary"


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of each row, padded, and their number."""
    data, offsets = blocks.bytes_of(column)
    size = np.diff(offsets) // 4
    out = np.zeros((len(size), width), np.uint32)
    where = np.arange(width)[None, :] < size[:, None]
    out[where] = np.frombuffer(data.tobytes(), ">u4")
    return out, size


def _common(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    same = (a == b) & (np.arange(a.shape[1])[None, :] < np.minimum(na, nb)[:, None])
    return np.logical_and.accumulate(same, axis=1).sum(axis=1)


def _compared(table: pa.Table, side: str, ends: bool = False) -> pa.RecordBatch:
    """Repeated spans (gram, context, l, r) from comparing sorted suffixes with the next ones, and bounds.

    A bound is the longest match of a suffix on the side it is sorted by first; the other of l and r is -1. Suffixes whose gram
    is whole in the table and has few enough contexts need none; `ends` says that grams are not whole.
    """
    gram, context = (table.column(c).to_numpy() for c in ("gram", "context"))
    before, n_before = _matrix(table.column("before"), BEFORE)
    after, n_after = _matrix(table.column("after"), AFTER)
    out = []
    for step in range(1, NEIGHBOURS + 1):
        i = np.arange(max(0, len(gram) - step))
        i = i[gram[i] == gram[i + step]]
        j = i + step
        left = _common(before[i], n_before[i], before[j], n_before[j])
        right = _common(after[i], n_after[i], after[j], n_after[j])
        long = left + right >= PASSAGE
        for k in (i[long], j[long]):
            out.append((gram[k], context[k], left[long].astype(np.int32), right[long].astype(np.int32)))
        if step == 1 and len(gram):
            most = np.zeros(len(gram), np.int32)
            np.maximum.at(most, np.concatenate([i, j]), np.tile(right if side == "after" else left, 2).astype(np.int32))
            _, of, n = np.unique(gram, return_inverse=True, return_counts=True)
            k = np.flatnonzero((most > 0) & (ends | (n[of] > NEIGHBOURS + 1) | (gram == gram[0]) | (gram == gram[-1])))
            none = np.full(len(k), -1, np.int32)
            out.append((gram[k], context[k], *((none, most[k]) if side == "after" else (most[k], none))))
    columns = [pa.array(np.concatenate([x[c] for x in out])) for c in range(4)]
    return pa.RecordBatch.from_arrays(columns, ["gram", "context", "l", "r"])


def _neighbours(suffixes: DataFrame, order: list[str]) -> DataFrame:
    """(gram, context, l, r) of all matches between near neighbours in the given order, and bounds, see `_compared`."""
    ranged = suffixes.repartitionByRange(*order).sortWithinPartitions(*order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Matches and bounds, and the first and last suffixes of the range (l and r are -1 for them)."""
        names = ["gram", "context", "l", "r", "before", "after"]
        tail = first = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if first is None:
                first = table.slice(0, NEIGHBOURS)
            elif first.num_rows < NEIGHBOURS:
                first = pa.concat_tables([first, table.slice(0, NEIGHBOURS - first.num_rows)])
            table = table if tail is None else pa.concat_tables([tail, table])
            found = _compared(table, order[1])
            none = pa.nulls(found.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([*found.columns, none, none], names)
            tail = table.slice(max(0, table.num_rows - NEIGHBOURS))
        if tail is not None:
            for edge in (first, tail):
                edge = edge.combine_chunks()
                minus = pa.array(np.full(edge.num_rows, -1, np.int32))
                columns = [edge.column(c).combine_chunks() for c in ("gram", "context", "before", "after")]
                yield pa.RecordBatch.from_arrays([columns[0], columns[1], minus, minus, columns[2], columns[3]], names)

    found = cut(ranged.mapInArrow(work, "gram bigint, context bigint, l int, r int, before binary, after binary"))
    edges = found.where("l < 0 and r < 0").select("gram", "context", "before", "after").distinct().orderBy(*order).coalesce(1)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [pa.Table.from_batches([b]) for b in batches]
        if table:
            yield _compared(pa.concat_tables(table), order[1], True)

    met = edges.mapInArrow(meet, "gram bigint, context bigint, l int, r int")
    return found.where("l >= 0 or r >= 0").select("gram", "context", "l", "r").unionByName(met)


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, context, l, hash, open) of each window of PASSAGE words of a suffix in `may`, that begins l words before the anchor."""
    for batch in batches:
        gram, context, may, opened = (batch.column(k).to_numpy() for k in range(4))
        sums = []
        for column, width, salt in ((batch.column(4), BEFORE, 1), (batch.column(5), AFTER, 2)):
            words, _ = _matrix(column, width)
            factors = blocks.mixed(np.arange(width, dtype=np.uint64) * blocks.FACTORS[20] + np.uint64(salt)) | np.uint64(1)
            total = np.zeros((len(words), width + 1), np.uint64)
            np.cumsum((words.astype(np.uint64) + np.uint64(1)) * factors, axis=1, out=total[:, 1:])
            sums.append(total)
        row, left = np.nonzero(may[:, None] >> np.arange(BEFORE + 1) & 1)
        hashes = blocks.mixed(sums[0][row, left] + blocks.mixed(sums[1][row, PASSAGE - left] + left.astype(np.uint64)))
        columns = [gram[row], context[row], left.astype(np.int32), hashes.view(np.int64), (opened[row] >> left & 1).astype(bool)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "context", "l", "hash", "open"])


def _others(suffixes: DataFrame, compared: DataFrame, whole: DataFrame) -> DataFrame:
    """(gram, context, l, r) of matches that `compared` leaves open; `whole` are the contexts that are repeated as they are."""
    windows = F.expr(f"shiftleft(1L, l + 1) - shiftleft(1L, greatest({PASSAGE} - r, 0))")  # a bit for each l
    done = compared.where("l >= 0 and r >= 0").select("gram", "context", windows.alias("done"))
    done = done.unionByName(whole.select("gram", "context", F.lit(-1).cast("long").alias("done")))
    done = done.groupBy("gram", "context").agg(F.bit_or("done").alias("done"))
    bounds = compared.where("l < 0 or r < 0").groupBy("gram", "context").agg(
        F.greatest(F.max("l"), F.lit(0)).alias("l"), F.greatest(F.max("r"), F.lit(0)).alias("r")
    )
    bounds = bounds.where(F.col("l") + F.col("r") >= PASSAGE).select("gram", "context", windows.alias("may"))
    bounds = bounds.join(done, ["gram", "context"], "left")
    bounds = cut(bounds.select("gram", "context", "may", F.expr("may & ~coalesce(done, 0L)").alias("open")))
    # Only spares work, as any such filter.
    held = suffixes.sparkSession.sparkContext.broadcast(key_filter(bounds.where("open <> 0").select("gram").distinct(), "gram"))

    def of_open_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_hold(held.value, batch.column(0).to_numpy())))

    rest = suffixes.mapInArrow(of_open_grams, _SUFFIX).join(bounds, ["gram", "context"])
    rest = rest.select("gram", "context", "may", "open", "before", "after")
    rest = cut(rest.mapInArrow(_window_rows, "gram bigint, context bigint, l int, hash bigint, open boolean"))
    twice = rest.groupBy("gram", "hash").agg(
        F.min("context").alias("low"), F.max("context").alias("high"), F.count_if("open").alias("n")
    )
    twice = cut(twice.where("low < high and n > 0").select("gram", "hash", "n"))
    rest = rest.where("open")
    found = hot_join(rest, twice, ["gram", "hash"], rest.count())
    return found.select("gram", "context", "l", (F.lit(PASSAGE) - F.col("l")).alias("r"))


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: id_col, n_words, n_repeated_words, spans (start:end in words, merged, comma-joined)."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    own = rows.where("id is not null")
    all_anchors = own.mapInArrow(_anchor_rows, "id bigint, place int, l int, r int, gram bigint, context bigint")
    all_anchors = cut(all_anchors)
    total = all_anchors.count()
    grams = all_anchors.groupBy("gram").agg(
        F.count("*").alias("n"), (F.min("context") < F.max("context")).alias("differ")
    )
    grams = cut(grams.where("n > 1"))
    twice = cut(hot_join(all_anchors, grams.select("gram", "n", "differ"), ["gram"], total))
    contexts = twice.groupBy("gram", "context", "differ").agg(
        ((F.min("id") < F.max("id")) | (F.min("place") < F.max("place"))).alias("whole"),
        F.min("l").alias("l"),
        F.min("r").alias("r"),
        F.count("*").alias("n"),
    )
    contexts = cut(contexts)
    edges = contexts.where("differ").select("gram", "context")
    held = docs.sparkSession.sparkContext.broadcast(key_filter(edges, "context"))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _each(batch.column(0)):
                hit = np.flatnonzero(may_hold(held.value, texts.context.view(np.int64)))
                _, one = np.unique(texts.context[hit], return_index=True)
                hit = hit[one]
                words = (texts.words >> np.uint64(32)).astype(">u4")
                columns = [
                    pa.array(texts.gram[hit].view(np.int64)),
                    pa.array(texts.context[hit].view(np.int64)),
                    pa.array([words[a:b][::-1].tobytes() for a, b in zip(texts.low[hit], texts.place[hit])], pa.binary()),
                    pa.array([words[a:b].tobytes() for a, b in zip(texts.place[hit], texts.high[hit])], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["gram", "context", "before", "after"])

    suffixes = own.select("text").mapInArrow(again, _SUFFIX).join(edges, ["gram", "context"], "left_semi")
    suffixes = cut(suffixes.dropDuplicates(["gram", "context"]))
    compared = _neighbours(suffixes, ["gram", "after", "before", "context"]).unionByName(
        _neighbours(suffixes, ["gram", "before", "after", "context"])
    )
    others = _others(suffixes, compared, contexts.where("differ and whole"))
    matches = compared.where("l >= 0 and r >= 0").unionByName(others)
    spans = contexts.where("whole").select("gram", "context", "l", "r").unionByName(matches).distinct()
    reach = spans.groupBy("gram", "context").agg(F.collect_list(F.struct("l", "r")).alias("reach"))
    reach = cut(reach.join(contexts.select("gram", "context", "n"), ["gram", "context"]))
    placed = hot_join(twice.select("id", "place", "gram", "context"), reach, ["gram", "context"], total)
    placed = placed.select("id", "place", F.inline("reach"))
    placed = placed.groupBy("id").agg(
        F.collect_set(F.struct((F.col("place") - F.col("l")).alias("a"), (F.col("place") + F.col("r")).alias("b"))).alias("spans")
    )

    @F.pandas_udf("struct<n:bigint,spans:string>")
    def merged(all_spans: pd.Series) -> pd.DataFrame:
        out = []
        for spans in all_spans:
            runs: list[list[int]] = []
            for a, b in sorted((s["a"], s["b"]) for s in spans):
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
            out.append((sum(b - a for a, b in runs), ",".join(f"{a}:{b}" for a, b in runs)))
        return pd.DataFrame(out, columns=["n", "spans"])

    placed = placed.select("id", merged("spans").alias("m")).select(F.col("id").alias("key"), "m.n", "m.spans")
    counted = rows.select("id", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_words"))
    counted = counted.groupBy("id").agg(F.max("n_words").alias("n_words"))
    return counted.join(placed, counted["id"] == placed["key"], "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_repeated_words"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
