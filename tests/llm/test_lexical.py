"""Ranked search against scoring all documents for all items by the definition."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from orestrata.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    """Sorted (item, rank, doc, score) by the definition; docs and items are pairs of id and text."""
    bags = [(i, Counter(words(t))) for i, t in docs]
    n_docs = sum(bool(b) for _, b in bags)
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, bag in bags:
            n, score = sum(bag.values()), 0
            for t in words(text):
                if t in bag:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 75 + (75 * n * n_docs) // total
                    score += w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i if i is not None else 0))
        for rank, (score, gone, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if gone else i, -score))
    return Counter(out)


def found(docs, items, **more):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.ranked(docs, items, **more).collect())


def test_equals_the_definition_on_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    asked = [(1, "W1 w2 w2 w40 v3"), (2, "changed few WORDS"), (3, None), (4, ""), (5, "nowhere"), (1, "W1 w2 w2 w40 v3"), (None, "wort v1")]
    items = spark.createDataFrame([(*a, "clash", 1) for a in asked], "item_id bigint, text string, id string, score int")
    assert found(odd, items) == plain(rows, asked)
    assert found(odd, items, k=2) == plain(rows, asked, 2)
    assert found(none, items) == Counter() == found(odd, items.where("1 = 0"))


def test_ties_blocks_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 3)
    monkeypatch.setattr(lexical, "LEADERS", 20)
    random.seed(4)
    letters = "alpha Beta gamma délta 12 ε zeta,eta theta_iota kappa".split(" ")
    docs = [(i, " ".join(random.choices(letters, range(9, 0, -1), k=random.randint(0, 12)))) for i in range(600)]
    docs += [(600 + i, "Beta kappa kappa") for i in range(300)]
    random.shuffle(docs)
    items = [(i, " ".join(random.choices(letters, k=random.randint(1, 6)))) for i in range(12)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    assert found(frame, asked) == plain(docs, items)


def test_bounds_lose_nothing():
    random = np.random.default_rng(5)
    for _ in range(200):
        sizes = random.integers(1, 8, 40)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        held = np.concatenate([random.choice(12, n, replace=False) for n in sizes])
        values = random.integers(1, 1000, len(held))
        norms = np.sqrt(np.add.reduceat(values.astype(float) ** 2, edges[:-1]))
        own, times = random.choice(12, 4, replace=False), random.integers(1, 4, 4)
        dense = np.zeros(12, np.int64)
        dense[own] = times
        want = np.add.reduceat(dense[held] * values, edges[:-1])
        bound = int(random.choice(want))
        rows, scores = lexical.Bucket(norms, edges, held, values, 12).search(own, times, bound, np.zeros(12, np.int64))
        good = np.flatnonzero((want >= bound) & (want > 0))
        assert rows.tolist() == good.tolist() and scores.tolist() == want[good].tolist()


def test_pieces_of_long_texts(monkeypatch):
    text = ("Wort über 12,x " * 50 + "y" * 90 + " z").encode()
    want = next(lexical.terms(text))
    monkeypatch.setattr(lexical, "PIECE", 16)
    pieces = list(lexical.terms(text))
    assert len(pieces) > 10 and [t for p in pieces for t in p] == want == [w.encode() for w in words(text.decode())]


def test_lengths_beyond_64_bits():
    n = np.array([3, 10**9], np.int64)
    assert lexical.lengths_of(n, 10**12, 10**14).tolist() == [25 + 75 * int(x) * 10**12 // 10**14 for x in n]


@pytest.mark.parametrize("tf, m, want", [(1, 25, 833333), (7, 40, 7 * 10**9 // 7320)])
def test_impacts(tf, m, want):
    assert lexical.impacts(np.array([tf]), np.array([m]))[0] == want
