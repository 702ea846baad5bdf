"""Token alignment against a plain two-pointer version that calls the libraries on whole texts."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from orestrata.llm import alignment

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
ODD = ["a  b   c", "  x", "x  ", "\n", "a \n b", "x▁y z", "a\tb \x1c c", "<|endoftext|> <s> <0x41>", "é 日本語 🙂 ﬁ", "it's  they'll 　x \xa0 y"]


@pytest.fixture(scope="module")
def codecs():
    return alignment.Codecs(*(open(path, "rb").read() for path in PATHS))


def plain(codecs, texts):
    """For each text n_a, n_b and its groups, or zeros; and its links."""
    out = []
    for text in texts:
        raw = (" " + (text or "")).encode()
        a = codecs.a.encode(raw.decode(), add_special_tokens=False).ids
        b = codecs.b.encode(text or "")
        if not text or b"".join(codecs.a_bytes[i] for i in a) != raw or b"".join(codecs.b_bytes[i] for i in b) != raw:
            out.append((0, 0, None, []))
            continue
        i = j = x = y = low_i = low_j = 0
        groups, links = [], []
        while i < len(a) and j < len(b):
            p, q = x + len(codecs.a_bytes[a[i]]), y + len(codecs.b_bytes[b[j]])
            if p == q:
                links.append((a[i], b[j]))
                groups.append(",".join(map(str, a[low_i : i + 1])) + "|" + ",".join(map(str, b[low_j : j + 1])))
                low_i, low_j = i + 1, j + 1
            if p <= q:
                i, x = i + 1, p
            if q <= p:
                j, y = j + 1, q
        out.append((len(a), len(b), ";".join(groups), links))
    return out


def expected(codecs, texts):
    found = plain(codecs, texts)
    counts = Counter(link for *_, links in found for link in links)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    for n_a, n_b, groups, links in found:
        best = sum(counts[link] == highest[link[1]] for link in links)
        digest = "" if groups is None else hashlib.sha256(groups.encode()).hexdigest()
        yield n_a, n_b, len(links), len(links), best, sum(counts[link] for link in links), digest, groups or ""


def test_query_equals_plain_version(spark, codecs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    more = [*ODD, None, "", "a" * 3000 + " " + "b " * 2000, docs.first().text]
    docs = docs.unionByName(spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(more)], docs.schema))
    rows = docs.collect()
    want = Counter((r.doc_id, *w) for r, w in zip(rows, expected(codecs, [r.text for r in rows])))
    assert Counter(map(tuple, alignment.aligned(docs, *PATHS, keep_groups=True).collect())) == want


def test_odd_rows_and_empty_table(spark, odd, none, codecs):
    rows = odd.collect()
    want = Counter((r.doc_id, *w[:-1]) for r, w in zip(rows, expected(codecs, [r.text for r in rows])))
    assert Counter(map(tuple, alignment.aligned(odd, *PATHS).collect())) == want
    assert alignment.aligned(none, *PATHS).count() == 0


def test_sections_and_lanes_change_nothing(codecs, monkeypatch):
    texts = ["wort schlüssel  und " * 200 + "▁" * k for k in range(2)] + ODD
    want = [(r.whole, r.n_a, r.n_b, r.n_groups, r.digest.hexdigest() if r.whole else "") for r in alignment._align(codecs, texts, False)]
    monkeypatch.setattr(alignment, "SECTION", 64)
    monkeypatch.setattr(alignment, "CACHED", 5)
    found = [(r.whole, r.n_a, r.n_b, r.n_groups, r.digest.hexdigest() if r.whole else "") for r in alignment._align(codecs, texts, False)]
    assert [f for f in found if f[0]] == [w for w in want if w[0]]
    a = np.cumsum(np.random.default_rng(1).integers(1, 5, 900))
    b = np.append(np.cumsum(np.random.default_rng(2).integers(1, 7, 500))[:400], a[-1])
    b = np.unique(b[b <= a[-1]])
    both = np.intersect1d(a, b)
    for lane in (1, 7, 100, 10**6):
        x, y = alignment.lockstep(a, b, np.array([0, a[-1]]), lane)
        assert (a[x] == both).all() and (b[y] == both).all()


def test_numbers_of_pairs(codecs):
    ids = codecs.b_of_slot()
    a = codecs.a.encode(" the thing’s über 12", add_special_tokens=False).ids
    for i in a:
        token = codecs.a_bytes[i]
        for j in np.flatnonzero([len(x) and (token.endswith(x) or x.endswith(token)) for x in codecs.b_bytes]):
            slot = codecs.slots(np.array([i]), np.array([j]))[0]
            assert 0 <= slot < codecs.n_slots and ids[slot] == j
