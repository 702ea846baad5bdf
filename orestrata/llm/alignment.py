"""Alignment of the tokens of two tokenizers by lockstep merging (operator 12).

Tokenizer A (byte-level BPE) reads a space and the text, tokenizer B (pieces) the text, which it begins with a space by itself; so
both see the same bytes. An offset at which a token of A and a token of B both end is a cut; cuts part the tokens into
groups. The two tokens that end at a cut are linked.

One numpy state holds a pair of pointers (into the ends of A's and B's tokens) for every lane of a batch; a lane is a document, or
a stretch of `LANE` bytes of it, since equal ends can never lie in different stretches. Each step compares all pointers at once,
emits links and cuts where the ends are equal, advances the pointer that is behind (both, where equal) and takes finished lanes out.

Texts are tokenised by the libraries, by units: a unit goes from a space that no space precedes and no blank follows up to the
next such space. No merge of either vocabulary crosses that place (checked for B when the model is loaded), so units are encoded
once per worker and remembered. A unit is whole if A's bytes, B's bytes and its own are the same; a text with another
unit has no tokens.

Two tokens can only be linked if one's bytes end with the other's. So a pair of ids has a number (`Codecs.slots`) below a bound that
depends on the two vocabularies alone (under 10^6 here), whatever the corpus: counts of all pairs are summed by Spark and
handed back as one array of that length.

Edge cases: null and empty texts and texts whose bytes differ (for example with U+2581, which B reads as a space) have zeros and an
empty digest; rows that share an id are aligned each by itself, and each counts; very long texts are done in sections of whole
units; an empty table gives an empty result; other columns are never read. Ties for the highest count all count as best.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestrata.llm.shared import cut

SECTION = 1 << 20
LANE = 1024
CACHED = 600_000
# White space to some engines only, or easily taken for it: no unit begins there.
_ODD = r"\s᠎​﻿"
_UNITS = re.compile(rf"(?<! )(?= [^{_ODD}])")
_RUNS = re.compile(rf" (?:[{_ODD}]|$)|\A[{_ODD}]")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones themselves, the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {**{chr(b): b for b in printable}, **{chr(256 + k): b for k, b in enumerate(others)}}


class Codecs:
    """Both vocabularies, the encodings of known units, and the numbers of linkable pairs."""

    def __init__(self, a_file: bytes, b_file: bytes) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        letter = _byte_letters()
        vocabulary = json.loads(a_file)["model"]["vocab"]
        self.a_bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for entry, number in vocabulary.items():
            self.a_bytes[number] = bytes(letter[x] for x in entry) if all(x in letter for x in entry) else b""
        self.b_bytes, self.b_byte = [], np.zeros(self.b.vocab_size(), bool)
        for number in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(number)
            self.b_byte[number] = self.b.is_byte(number)
            self.b_bytes.append(bytes([int(piece[3:-1], 16)]) if self.b_byte[number] else piece.replace("▁", " ").encode())
            if re.search("[^▁]▁", piece):
                raise ValueError(f"a piece goes beyond a word: {piece!r}")
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        self.b_start = np.concatenate([[0], np.cumsum(self.b_len + 1)])
        self.a_start = self.b_start[-1] + np.concatenate([[0], np.cumsum(2 * self.a_len)])
        self.n_slots = int(self.a_start[-1])
        self.decimals = decimals(max(len(self.a_bytes), len(self.b_bytes)))
        self.forget()

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The numbers of linked pairs of ids. The shorter token is the end of the longer one, so the longer one's id and the
        shorter one's length say which it is, but for B's byte pieces, which have a bit of their own."""
        short = self.a_len[a] <= self.b_len[b]
        return np.where(short, self.b_start[b] + self.a_len[a], self.a_start[a] + 2 * self.b_len[b] + self.b_byte[b])

    def b_of_slot(self) -> np.ndarray:
        """B's id for each number, -1 where there is no pair."""
        out = np.full(self.n_slots, -1, np.int64)
        out[: self.b_start[-1]] = np.repeat(np.arange(len(self.b_bytes)), self.b_len + 1)
        known = {(x, bool(k)): i for i, (x, k) in enumerate(zip(self.b_bytes, self.b_byte))}
        for number, token in enumerate(self.a_bytes):
            for size in range(1, len(token)):
                for byte in (False, True):
                    found = known.get((token[-size:], byte))
                    if found is not None:
                        out[self.a_start[number] + 2 * size + byte] = found
        return out

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.whole = np.zeros(0, bool)
        self.flat = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.edges = [np.zeros(1, np.int64), np.zeros(1, np.int64)]

    def learn(self, units: list[str]) -> None:
        """Encode new units; each is what follows its space, or all of it (with the space) if it holds a run of blanks."""
        # Units without runs of blanks are encoded as one text, which parts where they do.
        simple = [u for u in units if u[:1] != " "]
        for lo in range(0, len(simple), 4096):
            part = simple[lo : lo + 4096]
            if not self._learn_joined(part):
                self._learn_each(part)
        self._learn_each([u for u in units if u[:1] == " "])

    def _learn_joined(self, part: list[str]) -> bool:
        text = " " + " ".join(part)
        raw = text.encode()
        stops = np.cumsum(np.fromiter((len(u.encode()) + 1 for u in part), np.int64, len(part)))
        ids = [self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(text[1:])]
        counts = []
        for found, table, sizes in zip(ids, (self.a_bytes, self.b_bytes), (self.a_len, self.b_len)):
            ends = np.cumsum(sizes[np.array(found, np.int64)])
            at = np.searchsorted(ends, stops)
            if b"".join([table[i] for i in found]) != raw or (ends[at] != stops).any():
                return False  # some unit has no tokens, or parts elsewhere
            counts.append(np.diff(at, prepend=-1))
        self._remember(part, np.ones(len(part), bool), [np.array(x, np.int32) for x in ids], counts)
        return True

    def _learn_each(self, part: list[str]) -> None:
        if not part:
            return
        full = [u if u[:1] == " " else " " + u for u in part]
        ids = [
            [x.ids for x in self.a.encode_batch_fast(full, add_special_tokens=False)],
            self.b.encode([u[1:] for u in full], num_threads=1),
        ]
        joined = [[b"".join([t[i] for i in x]) for x in found] for t, found in zip((self.a_bytes, self.b_bytes), ids)]
        whole = np.array([p == q == u.encode() for p, q, u in zip(*joined, full)], bool)
        flat = [np.fromiter(chain.from_iterable(x), np.int32) for x in ids]
        self._remember(part, whole, flat, [np.fromiter(map(len, x), np.int64, len(part)) for x in ids])

    def _remember(self, part: list[str], whole: np.ndarray, flat: list[np.ndarray], counts: list[np.ndarray]) -> None:
        self.whole = np.concatenate([self.whole, whole])
        for k in range(2):
            self.flat[k] = np.concatenate([self.flat[k], flat[k]])
            self.edges[k] = np.concatenate([self.edges[k], self.edges[k][-1] + np.cumsum(counts[k])])
        self.known.update(zip(part, range(len(self.known), len(self.known) + len(part))))

    def sections(self, text: str) -> Iterator[list[str]]:
        """Units of a text, in sections of about SECTION characters."""
        if _RUNS.search(text):
            units = [u[1:] if " " not in u[1:] and not _RUNS.match(u[1:]) else u for u in _UNITS.split(" " + text) if u]
        else:
            units = text.split(" ")
        if len(text) <= SECTION:
            yield units
            return
        edges = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)) + 1)
        marks = np.flatnonzero(np.diff(edges // SECTION, prepend=0)) + 1
        for lo, hi in zip([0, *marks], [*marks, len(units)]):
            if lo < hi:
                yield units[lo:hi]

    def encode(self, sections: list[list[str]]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """For each section whether it is whole; A's and B's ids; for each its n + 1 offsets into them."""
        if len(self.known) > CACHED:
            self.forget()
        new = set().union(*sections).difference(self.known)
        if new:
            self.learn(sorted(new))
        counts = np.fromiter(map(len, sections), np.int64, len(sections))
        units = np.fromiter(map(self.known.__getitem__, chain.from_iterable(sections)), np.int64, int(counts.sum()))
        places = np.concatenate([[0], np.cumsum(counts)])
        lost = np.concatenate([[0], np.cumsum(~self.whole[units])])
        ids, offsets = [], []
        for flat, edges in zip(self.flat, self.edges):
            sizes = edges[units + 1] - edges[units]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            ids.append(flat[np.repeat(edges[units] - ends[:-1], sizes) + np.arange(ends[-1])])
            offsets.append(ends[places])
        return lost[places[1:]] == lost[places[:-1]], ids, offsets


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, edges: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the tokens of A and of B that end together, in order.

    `a_ends`, `b_ends` are rising end offsets over all texts of the batch, `edges` the n + 1 offsets where texts begin and end.
    """
    sizes = np.maximum(-(-np.diff(edges) // lane), 1)
    first = np.concatenate([[0], np.cumsum(sizes)])
    low = np.repeat(edges[:-1] - first[:-1] * lane, sizes) + np.arange(first[-1]) * lane
    high = np.minimum(low + lane, np.repeat(edges[1:], sizes))
    p, p_end = np.searchsorted(a_ends, low, "right"), np.searchsorted(a_ends, high, "right")
    q, q_end = np.searchsorted(b_ends, low, "right"), np.searchsorted(b_ends, high, "right")
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while True:
        going = (p < p_end) & (q < q_end)
        if not going.all():
            p, p_end, q, q_end = p[going], p_end[going], q[going], q_end[going]
        if not len(p):
            break
        x, y = a_ends[p], b_ends[q]
        both = x == y
        found_a.append(p[both])
        found_b.append(q[both])
        p = p + (x <= y)
        q = q + (y <= x)
    # Both rise along the texts, so sorting each by itself keeps partners together.
    return np.sort(np.concatenate(found_a)), np.sort(np.concatenate(found_b))


def written(a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, decimals: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Groups as bytes (`a1,a2|b1;a3|b2,b3;`), and for each group the offset behind it."""
    sizes_a, sizes_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    at_a = np.arange(len(a)) + np.repeat(np.concatenate([[0], last_b[:-1] + 1]), sizes_a)
    at_b = np.arange(len(b)) + np.repeat(last_a + 1, sizes_b)
    ids, marks = np.empty(len(a) + len(b), np.int32), np.full(len(a) + len(b), ord(","), np.uint8)
    ids[at_a], ids[at_b] = a, b
    marks[at_a[last_a]], marks[at_b[last_b]] = ord("|"), ord(";")
    # A row of bytes for each id: its digits, the mark, zeros.
    rows, digits = decimals[0][ids], decimals[1][ids]
    rows[np.arange(len(ids)), digits] = marks
    return rows[rows != 0], np.cumsum(digits + 1)[at_b[last_b]]


def decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of the numbers below n as zero-filled rows with a free place behind them, and their lengths."""
    text = np.array([str(i) for i in range(n)], "S")
    wide = text.view(np.uint8).reshape(n, -1)
    return np.concatenate([wide, np.zeros((n, 1), np.uint8)], axis=1), np.char.str_len(text).astype(np.int64)


class _Row:
    """What is known of one text while its sections are done."""

    def __init__(self) -> None:
        self.whole, self.n_a, self.n_b, self.n_groups = True, 0, 0, 0
        self.digest, self.slots, self.groups = hashlib.sha256(), [], []


def _align(codecs: Codecs, texts: list[str | None], keep: bool) -> list[_Row]:
    rows = [_Row() for _ in texts]
    waiting: list[tuple[int, list[str]]] = []
    size = 0

    def flush() -> None:
        whole, (a, b), (a_off, b_off) = codecs.encode([s for _, s in waiting])
        # Sections that aren't whole have bytes that differ; only the others are merged.
        good = np.flatnonzero(whole)
        for n in np.flatnonzero(~whole):
            rows[waiting[n][0]].whole = False
        keep_a = np.concatenate([np.arange(a_off[n], a_off[n + 1]) for n in good] or [np.zeros(0, np.int64)])
        keep_b = np.concatenate([np.arange(b_off[n], b_off[n + 1]) for n in good] or [np.zeros(0, np.int64)])
        a, b = a[keep_a], b[keep_b]
        n_a, n_b = np.diff(a_off)[good], np.diff(b_off)[good]
        a_ends, b_ends = np.cumsum(codecs.a_len[a]), np.cumsum(codecs.b_len[b])
        edges = np.concatenate([[0], a_ends[np.cumsum(n_a) - 1]]) if len(good) else np.zeros(1, np.int64)
        last_a, last_b = lockstep(a_ends, b_ends, edges)
        raw, behind = written(a, b, last_a, last_b, codecs.decimals)
        slots = codecs.slots(a[last_a], b[last_b]).astype(np.int32)
        groups = np.searchsorted(last_a, np.concatenate([[0], np.cumsum(n_a)]))
        raw = memoryview(raw)
        for k, n in enumerate(good):
            row, lo, hi = rows[waiting[n][0]], groups[k], groups[k + 1]
            row.n_a += int(n_a[k])
            row.n_b += int(n_b[k])
            text = raw[behind[lo - 1] if lo else 0 : behind[hi - 1] - 1]
            if row.n_groups:
                row.digest.update(b";")
            row.digest.update(text)
            if keep:
                row.groups.append(bytes(text))
            row.n_groups += int(hi - lo)
            row.slots.append(slots[lo:hi].tobytes())
        waiting.clear()

    for number, text in enumerate(texts):
        if not text:
            rows[number].whole = False
            continue
        for section in codecs.sections(text):
            waiting.append((number, section))
            size += sum(map(len, section))
            if size >= SECTION:
                flush()
                size = 0
    if waiting:
        flush()
    return rows


def aligned(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = False
) -> DataFrame:
    """A row for each row of `docs`: id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and with
    `keep_groups` the groups themselves (`groups string`). Paths are those of A's JSON file and of B's model."""
    files = []
    for path in (a_path, b_path):
        with open(path, "rb") as file:
            files.append(file.read())
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tuple(files))
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "n_a", "n_b", "n_groups", "groups_sha256", "slots"] + ["groups"] * keep_groups
    schema = f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, slots binary"

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codecs = _codecs_of(shared)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                rows = _align(codecs, part.column(1).to_pylist(), keep_groups)
                columns = [
                    part.column(0),
                    *(pa.array([getattr(r, n) if r.whole else 0 for r in rows], pa.int64()) for n in names[1:4]),
                    pa.array([r.digest.hexdigest() if r.whole else "" for r in rows], pa.string()),
                    pa.array([b"".join(r.slots) if r.whole else b"" for r in rows], pa.binary()),
                ]
                if keep_groups:
                    columns.append(pa.array([b";".join(r.groups).decode() if r.whole else "" for r in rows], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for slots, _ in _slots(batch.column(0)):
                if total is None:
                    total = np.zeros(_codecs_of(shared).n_slots, np.int64)
                total += np.bincount(slots, minlength=len(total))
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["slot", "n"])

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = cut(found.mapInArrow(align, schema + ", groups string" * keep_groups))
    # At most n_slots rows, which the two vocabularies bound.
    sums = found.select("slots").mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    codecs = Codecs(*files)
    counts = np.zeros(codecs.n_slots, np.int64)
    counts[ints(sums["slot"])] = ints(sums["n"])
    b_of = codecs.b_of_slot()
    highest = np.zeros(len(codecs.b_bytes), np.int64)
    used = np.flatnonzero(counts)
    np.maximum.at(highest, b_of[used], counts[used])
    best = np.zeros(codecs.n_slots, bool)
    best[used] = counts[used] == highest[b_of[used]]
    facts = spark.sparkContext.broadcast((counts, best))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = facts.value
        place = names.index("slots")
        more = ["n_links", "n_best", "count_sum"]
        for batch in batches:
            sums = [np.zeros((0, 3), np.int64)]
            for slots, edges in _slots(batch.column(place)):
                values = np.stack([np.ones(len(slots), np.int64), best[slots], counts[slots]])
                total = np.concatenate([np.zeros((3, 1), np.int64), np.cumsum(values, axis=1)], axis=1)
                sums.append((total[:, edges[1:]] - total[:, edges[:-1]]).T)
            sums = np.concatenate(sums)
            rest = [c for k, c in enumerate(batch.columns) if k != place]
            own = [n for n in names if n != "slots"]
            yield pa.RecordBatch.from_arrays([*rest, *(pa.array(sums[:, k]) for k in range(3))], own + more)

    own = schema.removesuffix(", slots binary") + ", groups string" * keep_groups
    found = found.mapInArrow(look_up, own + ", n_links bigint, n_best bigint, count_sum bigint")
    order = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] + ["groups"] * keep_groups
    return found.select(F.col("id").alias(id_col), *order)


def ints(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy()


def _slots(column: pa.Array, rows: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pair numbers of some rows at a time, and the n + 1 offsets of the rows."""
    for lo in range(0, len(column), rows):
        parts = [np.frombuffer(x.as_buffer(), np.int32) for x in column.slice(lo, rows)]
        yield np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)


_known: dict[tuple[int, int], Codecs] = {}


def _codecs_of(shared) -> Codecs:
    """The codecs of this worker, made once from the broadcast files."""
    key = tuple(map(hash, shared.value))
    if key not in _known:
        _known[key] = Codecs(*shared.value)
    return _known[key]
