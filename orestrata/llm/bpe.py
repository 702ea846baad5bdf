"""Byte-level BPE encoding and decoding by overlapping chunks (operator 2).

A text is cut into chunks of `CHUNK` characters, each with `OVERLAP` more characters of the next one. Every chunk is
pre-tokenised and encoded by itself, by any task. A chunk that starts inside a pre-token may begin with wrong
boundaries, but a match of the pattern depends only on what follows its start (and `LOOK` characters behind its
end), so from the first boundary that two chunks share they agree for ever. Stitching takes the earlier chunk up to
that boundary and the later one from there. If the overlap holds no shared boundary (a very long run of letters,
say) the text from the earlier chunk's last sure boundary is pre-tokenised anew together with the later chunk's
until they meet.

Pieces are encoded as merging by rank (lowest first, leftmost on ties) would; see `Codec.encode_piece`. Decoding looks the
ids up and joins their bytes.

Texts of one chunk (nearly all) are done in one pass without a shuffle. Chunks of longer texts are spread over all tasks and
then gathered by text; a task then holds one text's chunks, as a row of it does anyway.

Edge cases: a null is an empty text with no tokens; rows that share an id are encoded each by itself; an empty table
gives an empty result; other columns are never read. Ranks are read by the driver from the path given and
broadcast: a vocabulary of fixed size.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 32_768
OVERLAP = 256
LOOK = 4
CACHED = 500_000
SEEN = 1 << 22

# Unicode's white space; `\s` of some engines takes in the separators U+001C to U+001F too.
_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def plain_pattern(pattern: str) -> str:
    """The pattern with white space spelled out, so that it means the same in every regex engine."""
    outside = pattern.replace(r"[^\s", f"[^{_SPACE}")
    return outside.replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]")


class Codec:
    """Ranks of byte strings, and the merges they stand for."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.pattern = regex.compile(plain_pattern(pattern))
        self.pieces = self.pattern.findall
        self.table = {i: b for b, i in ranks.items()}
        self.packed = {b: i.to_bytes(4, "little") for b, i in ranks.items()}
        self.space = regex.compile(f"[{_SPACE}]")
        # Ids of what follows a blank, of units met twice; where the hashes of those met before fall.
        self.known: dict[str, bytes] = {}
        self.seen = bytearray(SEEN)
        self.marks = 0
        # By their first four bytes, the length of the longest token.
        self.longest: dict[bytes, int] = {}
        for token in ranks:
            if len(token) > 3:
                self.longest[token[:4]] = max(len(token), self.longest.get(token[:4], 0))
        self.met: dict[tuple[bytes, bytes], bool] = {}

    def match(self, text: str, at: int) -> str:
        return self.pattern.match(text, at).group()

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of a piece by its definition: merge the pair of lowest rank, the leftmost on ties, until none is left."""
        rank = self.ranks.get
        if (found := rank(piece)) is not None:
            return (found,)
        # Parts are linked by the start of the next one; the heap holds pairs that may be merged.
        n = len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or after[j] - i != size:
                continue
            alive[j] = False
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank(piece[i : after[k]])) is not None:
                    heapq.heappush(heap, (r, i, after[k] - i))
            h = before[i]
            if h >= 0 and (r := rank(piece[h:k])) is not None:
                heapq.heappush(heap, (r, h, k - h))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return tuple(out)

    def agree(self, a: bytes, b: bytes) -> bool:
        """Whether two tokens stay as they are when they meet; remembered."""
        if len(self.met) >= CACHED:
            self.met.clear()
        found = self.met[a, b] = self.merge(a + b) == (self.ranks[a], self.ranks[b])
        return found

    def encode_piece(self, piece: bytes) -> bytes:
        """Ids of a pre-token. A sequence of tokens is its encoding if and only if all neighbours agree, so the
        longest tokens are tried first and given up where they don't; which neighbours agree is remembered."""
        ranks, n = self.ranks, len(piece)
        if piece in ranks:
            return self.packed[piece]
        if n > 64:
            return np.array(self.merge(piece), "<u4").tobytes()
        longest, met = self.longest, self.met
        tokens: list[bytes] = []
        dead = set()  # positions from which no agreeing sequence goes on
        at, size, left = 0, n, None
        while at < n:
            size = min(size, longest.get(piece[at : at + 4], 3))
            while size:
                token = piece[at : at + size]
                if token in ranks and at + size not in dead:
                    if left is None:
                        break
                    agreed = met.get((left, token))
                    if agreed is None:
                        agreed = self.agree(left, token)
                    if agreed:
                        break
                size -= 1
            if size:
                tokens.append(token)
                at += size
                size, left = n - at, token
            else:
                dead.add(at)
                size = len(tokens.pop())
                at -= size
                size -= 1
                left = tokens[-1] if tokens else None
        packed = self.packed
        return b"".join([packed[t] for t in tokens])

    def unit(self, unit: str) -> bytes:
        """Ids of a blank and what follows it up to the next one."""
        out = []
        for piece in self.pieces(" " + unit):
            if piece[0] == " " and len(piece) <= len(unit):
                out.append(self.word(piece))
            else:
                out.append(self.encode_piece(piece.encode()))
        return b"".join(out)

    def word(self, piece: str) -> bytes:
        """Ids of a pre-token that begins with a blank; remembered."""
        known, rest = self.known, piece[1:]
        found = known.get(rest)
        if found is None:
            found = known[rest] = self.encode_piece(piece.encode())
        return found

    def forget(self) -> None:
        """Bounds memory, not results."""
        if len(self.known) >= CACHED:
            self.known.clear()
        if self.marks >= SEEN // 4:
            self.seen, self.marks = bytearray(SEEN), 0

    def first_met(self, unit: str) -> bool:
        at = hash(unit) % SEEN
        if self.seen[at]:
            return False
        self.seen[at] = 1
        self.marks += 1
        return True

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit numbers.

        A pre-token always begins at a blank that is followed by something else than white space, so texts are
        split there, and what follows a blank is looked up as a whole.
        """
        first, *units = text.split(" ")
        self.forget()
        known, once = self.known, []
        for unit in set(units).difference(known):
            if not unit or self.space.match(unit):
                return b"".join([self.encode_piece(p.encode()) for p in self.pieces(text)])
            known[unit] = self.unit(unit)
            if self.first_met(unit):
                once.append(unit)
        head = b"".join([self.encode_piece(p.encode()) for p in self.pieces(first)])
        ids = head + b"".join(map(known.__getitem__, units))
        for unit in once:  # most units never come again
            known.pop(unit, None)
        return ids

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def cut_pieces(codec: Codec, chunk: str) -> tuple[bytes, bytes, bytes]:
    """Pre-tokens of a chunk: the n + 1 offsets of their boundaries, their numbers of tokens, all ids."""
    codec.forget()
    pieces = codec.pieces(chunk)
    ids = [codec.word(piece) if piece[0] == " " and len(piece) > 1 else codec.encode_piece(piece.encode()) for piece in pieces]
    edges = np.cumsum([0, *map(len, pieces)], dtype=np.uint32)
    return edges.tobytes(), np.array([len(x) // 4 for x in ids], np.uint32).tobytes(), b"".join(ids)


def stitched(codec: Codec, chunks: list[tuple[int, str, bytes, bytes, bytes]], size: int = CHUNK) -> bytes:
    """Ids of a text from its chunks in order: start, characters, and what `cut_pieces` found."""
    text = "".join([part[:size] for _, part, *_ in chunks[:-1]]) + chunks[-1][1]
    out: list[bytes] = []
    at = 0  # a boundary of the whole text; all before it is done
    for number, (start, part, edges, counts, ids) in enumerate(chunks):
        last = number == len(chunks) - 1
        own = np.frombuffer(edges, np.uint32).astype(np.int64) + start
        ends = np.concatenate([[0], np.cumsum(np.frombuffer(counts, np.uint32), dtype=np.int64)]) * 4
        sure = len(own) - 1 if last else int(np.searchsorted(own, start + len(part) - LOOK, "right")) - 1
        while at < own[max(sure, 0)]:
            k = int(np.searchsorted(own, at))
            if own[k] == at:  # in step from here on
                out.append(ids[ends[k] : ends[sure]])
                at = int(own[sure])
                break
            piece = codec.match(text, at)
            out.append(codec.encode_piece(piece.encode()))
            at += len(piece)
    return b"".join(out)


def encoded(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False
) -> DataFrame:
    """A row for each row of `docs`: id_col, n_tokens, ids_sha256, decoded_sha256, n_bytes (of the decoded text), and
    with `keep_ids` the ids themselves as little-endian 32-bit numbers (`ids binary`)."""
    with open(path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast((file.read(), pattern))
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"] + ["ids"] * keep_ids
    result = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_bytes bigint" + ", ids binary" * keep_ids

    def batch_of(key: pa.Array, all_ids: list[bytes], codec: Codec) -> pa.RecordBatch:
        raw = [codec.decode(ids) for ids in all_ids]
        columns = [
            pa.array([len(ids) // 4 for ids in all_ids], pa.int64()),
            pa.array([hashlib.sha256(ids).hexdigest() for ids in all_ids], pa.string()),
            pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string()),
            pa.array([len(x) for x in raw], pa.int64()),
        ]
        if keep_ids:
            columns.append(pa.array(all_ids, pa.binary()))
        return pa.RecordBatch.from_arrays([key, *columns], names)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                yield batch_of(part.column(0), [codec.encode(t) for t in part.column(1).to_pylist()], codec)

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            found = [cut_pieces(codec, t) for t in batch.column(4).to_pylist()]
            more = [pa.array([x[k] for x in found], pa.binary()) for k in range(3)]
            names = ["key", "id", "number", "start", "part", "edges", "counts", "ids"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names)

    def stitch(table: pa.Table) -> pa.Table:
        codec = _codec(shared)
        table = table.sort_by("number")
        chunks = list(zip(*(table.column(c).to_pylist() for c in ("start", "part", "edges", "counts", "ids"))))
        return pa.Table.from_batches([batch_of(table.column("id").combine_chunks()[:1], [stitched(codec, chunks)], codec)])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    one = rows.where(F.length("text") <= CHUNK).mapInArrow(whole, result)
    # Rows may share an id, so each text has a key of its own.
    long = rows.where(F.length("text") > CHUNK).withColumn("key", F.monotonically_increasing_id())
    count = F.ceil(F.length("text") / CHUNK).cast("int")
    parts = long.select("key", "id", "text", F.explode(F.sequence(F.lit(0), count - 1)).alias("number")).select(
        "key",
        "id",
        "number",
        (F.col("number") * CHUNK).alias("start"),
        F.substring("text", F.col("number") * CHUNK + 1, F.lit(CHUNK + OVERLAP)).alias("part"),
    )
    parts = parts.repartition("key", "number")
    schema = f"key bigint, id {kind}, number int, start int, part string, edges binary, counts binary, ids binary"
    many = parts.mapInArrow(chunk, schema).groupBy("key").applyInArrow(stitch, result)
    return one.unionByName(many).withColumnRenamed("id", id_col)


_codecs: dict[tuple[int, str], Codec] = {}


def _codec(shared) -> Codec:
    """The codec of this worker, made once from the broadcast file."""
    raw, pattern = shared.value
    key = (hash(raw), pattern)
    if key not in _codecs:
        _codecs[key] = Codec({base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}, pattern)
    return _codecs[key]
