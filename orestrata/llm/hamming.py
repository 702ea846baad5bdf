"""Exact top-k search over binary codes by incremental multi-index hashing (operator 4).

A vector's code has one bit for each number, set where it is above 0. The k nearest rows of a query are those of
smallest Hamming distance, of smallest id on ties.

Distinct codes are dealt by hash into blocks of about `BLOCK`; queries, distinct too, into blocks of `QUERIES`. Every block of
queries meets every block of codes once (a stated query set against all rows, in blocks). A meeting cuts codes into M
segments of about log2(block) bits and sorts each segment's values. For radius 0, 1, 2 ... of one segment after the
other, it looks up all values at that radius from the query's segment and verifies the whole codes found there. When
all segments were searched to radius r and j of them to r + 1, every code at a distance of at most M r + r_j - 1
(r_j = M + j) has been seen, since a code further off in every segment is further in sum; a query is done when its
kth verified distance is covered. Queries first meet one block, whose kth distance bounds the radius everywhere else.

Scale: no pair of rows leaves a meeting but the k best of a query, so what is shuffled is k rows for each query and block. A
code's rows are reduced to their k smallest ids, the only ones that can be among k best, so copies cost nothing.

Edge cases: a null vector, an empty one, or one with nulls or another length than `bits` has no code: it neither asks nor is
found. NaN counts as not above 0. Rows that share an id and code count once; fewer than k rows give fewer answers.
An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orestrata.llm.shared import cut

K = 10
BLOCK = 8192
QUERIES = 2048
_FAR = 1 << 30


def code_of(vector: Column, bits: int) -> Column:
    """The code as a text of 0 and 1 packed to bytes; null without a valid vector."""
    ok = (F.size(vector) == bits) & ~F.exists(vector, lambda x: x.isNull())
    bit = F.transform(vector, lambda x: F.when((x > 0) & ~F.isnan(x), "1").otherwise("0"))
    text = F.rpad(F.array_join(bit, ""), -(-bits // 64) * 64, "0")
    parts = [F.lpad(F.conv(F.substring(text, i * 64 + 1, 64), 2, 16), 16, "0") for i in range(-(-bits // 64))]
    return F.when(ok, F.unhex(F.concat(*parts)))


def _matrix(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)


class Index:
    """Segment tables of a block of codes, given as rows of bytes."""

    def __init__(self, codes: np.ndarray, bits: int) -> None:
        self.codes = np.ascontiguousarray(codes)
        self.bits = bits
        width = max(4, min(20, ceil(log2(max(2, len(codes))))))
        self.m = max(1, bits // width)
        self.cuts = np.linspace(0, bits, self.m + 1).astype(int)
        self.tables = []
        for part in self.segments(codes):
            order = np.argsort(part, kind="stable")
            self.tables.append((part[order], order))

    def segments(self, codes: np.ndarray) -> list[np.ndarray]:
        flat = np.unpackbits(codes, axis=1)[:, : self.bits].astype(np.int64)
        return [flat[:, a:b] @ (1 << np.arange(b - a)) for a, b in zip(self.cuts, self.cuts[1:])]

    def search(self, queries: np.ndarray, k: int, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, code, distance) of all codes that are among the k nearest of a query, ties included, as far as their
        distance is at most the query's bound."""
        n, parts = len(queries), self.segments(queries)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        near = np.zeros((n, self.bits + 1), np.int64)  # verified codes by distance
        kth = np.minimum(bound, self.bits)
        active = np.arange(n)
        for radius in range(int(np.diff(self.cuts).max()) + 1):
            for j in range(self.m):
                if not len(active):
                    break
                width = self.cuts[j + 1] - self.cuts[j]
                if radius <= width:
                    masks = np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], np.int64)
                    for lo in range(0, len(active), max(1, 200_000 // len(masks))):
                        some = active[lo : lo + max(1, 200_000 // len(masks))]
                        q, c, d = self._probe(queries, parts, j, radius, some, masks)
                        keep = d <= kth[q]
                        q, c, d = q[keep], c[keep], d[keep]
                        found.append((q, c, d))
                        np.add.at(near, (q, d), 1)
                # Codes not seen yet are at least this far.
                open_from = self.m * radius + j + 1
                enough = near[active].cumsum(axis=1) >= k
                best = np.where(enough.any(axis=1), enough.argmax(axis=1), self.bits)
                kth[active] = np.minimum(kth[active], best)
                active = active[kth[active] >= open_from]
        if not found:
            return (np.zeros(0, np.int64),) * 3
        q, c, d = (np.concatenate(x) for x in zip(*found))
        keep = d <= kth[q]
        return q[keep], c[keep], d[keep]

    def _probe(self, queries, parts, j, radius, some, masks):
        """Codes whose segment j is at this radius, and that no earlier step has met: their query, place and distance."""
        values, order = self.tables[j]
        wanted = (parts[j][some][:, None] ^ masks[None, :]).ravel()
        first = np.searchsorted(values, wanted)
        count = np.searchsorted(values, wanted, "right") - first
        hit = np.flatnonzero(count)
        q = np.repeat(some[hit // len(masks)], count[hit])
        at = np.arange(len(q)) - np.repeat(np.cumsum(count[hit]) - count[hit], count[hit])
        c = order[np.repeat(first[hit], count[hit]) + at]
        differ = np.bitwise_count(queries[q] ^ self.codes[c])
        d = differ.sum(axis=1, dtype=np.int64)
        new = np.ones(len(q), bool)
        for i in range(self.m):  # met before: another segment is nearer, or as near and earlier
            if i != j:
                other = np.bitwise_count(parts[i][q] ^ self._part(i)[c])
                new &= (other > radius) | ((other == radius) & (i > j))
        return q[new], c[new], d[new]

    def _part(self, i: int) -> np.ndarray:
        values, order = self.tables[i]
        plain = np.empty(len(order), np.int64)
        plain[order] = values
        return plain


def _blocked(codes: DataFrame, size: int, count: int, name: str) -> DataFrame:
    """Codes gathered into blocks of about `size`: (name, codes)."""
    blocks = max(1, ceil(count / size))
    dealt = codes.withColumn(name, F.pmod(F.xxhash64("code"), F.lit(blocks)))
    return dealt.groupBy(name).agg(F.sort_array(F.collect_list("code")).alias(f"{name}s"))


def nearest(
    vectors: DataFrame, queries: DataFrame, bits: int, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """A row (query_id, rank, id_col, distance) for each of the k nearest rows of each query, itself included if it is a row."""
    coded = vectors.select(F.col(id_col).alias("id"), code_of(F.col(vector_col), bits).alias("code"))
    coded = coded.where("code is not null and id is not null").distinct()
    rank = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    rows = cut(coded.withColumn("place", rank).where(F.col("place") <= k))
    asked = cut(
        queries.select(F.col(id_col).alias("query_id"), code_of(F.col(vector_col), bits).alias("code"))
        .where("code is not null and query_id is not null")
        .distinct()
    )
    codes, questions = rows.select("code").distinct(), asked.select("code").distinct()
    n_codes, n_questions = codes.count(), questions.count()
    left = cut(_blocked(codes, BLOCK, n_codes, "block"))
    blocks = max(1, ceil(n_codes / BLOCK))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                questions = _matrix(row["asks"])
                bound = np.array(row["bounds"], np.int64)
                index = Index(_matrix(row["blocks"]), bits)
                q, c, d = index.search(questions, k, bound)
                columns = [
                    pa.array([row["asks"][i] for i in q.tolist()], pa.binary()),
                    pa.array([row["blocks"][i] for i in c.tolist()], pa.binary()),
                    pa.array(d.astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["ask", "code", "distance"])

    def met(asks: DataFrame) -> DataFrame:
        """`asks`: (block, asks, bounds)."""
        pairs = asks.join(left, "block").select("asks", "bounds", "blocks")
        return pairs.repartition(F.xxhash64("asks", "blocks")).mapInArrow(meet, "ask binary, code binary, distance int")

    # Each question meets one block, which bounds its kth distance.
    ask_blocks = max(1, ceil(n_questions / QUERIES))
    group = F.pmod(F.xxhash64("code", F.lit(1)), F.lit(ask_blocks)).alias("ask")
    bounds = F.transform("asks", lambda _: F.lit(_FAR))
    first = questions.select("code", group).groupBy("ask").agg(F.sort_array(F.collect_list("code")).alias("asks"))
    first = first.select("asks", bounds.alias("bounds"), F.pmod("ask", F.lit(blocks)).alias("block"))
    start = cut(met(first))
    seen = start.groupBy("ask").agg(F.sort_array(F.collect_list("distance")).alias("d"))
    bound = seen.select("ask", F.when(F.size("d") >= k, F.get("d", F.lit(k - 1))).otherwise(_FAR).alias("bound"))
    again = bound.select("ask", "bound", F.pmod(F.xxhash64("ask", F.lit(1)), F.lit(ask_blocks)).alias("g"))
    again = again.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("ask", "bound"))).alias("all"))
    again = again.select(
        F.col("all.ask").alias("asks"),
        F.col("all.bound").alias("bounds"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod("g", F.lit(blocks)).alias("done"),
    )
    rest = met(again.where("block <> done").select("asks", "bounds", F.col("block").cast("bigint").alias("block")))
    best = start.unionByName(rest)
    # k codes at most matter to a question (and codes at the same distance as the kth, for their ids).
    by_code = F.rank().over(Window.partitionBy("ask").orderBy("distance"))
    best = best.withColumn("place", by_code).where(F.col("place") <= k).drop("place")
    answers = best.join(rows.select("code", "id"), "code").join(asked.withColumnRenamed("code", "ask"), "ask")
    order = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    ranked = answers.select("query_id", order.alias("rank"), F.col("id").alias(id_col), "distance")
    return ranked.where(F.col("rank") <= k)
