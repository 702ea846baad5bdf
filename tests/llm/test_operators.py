"""Each operator on odd rows and on an empty table, and against plain versions on small ones."""

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from orestrata.llm import (
    bpe,
    hamming,
    line_dedup,
    line_rules,
    mixing,
    near_dedup,
    passages,
    personal_data,
    quality,
    shared,
    toxicity,
)

LONG = "wort " * 40_000 + "x" * 60_000  # as in conftest
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
ENCODING = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, 1 - i % 2) for i in (1, 2, 3, 4, 6, 8, 9)] + [(1, None, None), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def by_id(df, key="doc_id"):
    return {row[key]: row for row in df.collect()}


def test_near_dedup(odd, none):
    found = by_id(near_dedup.near_duplicates(odd))
    assert [found[i].class_id for i in (1, 2, 3, 4, 5, 6, 7, 8, 9)] == [1, 1, 1, 4, 5, 5, 7, 8, 9]
    assert len(found) == 10 and found[None].class_id == 1
    kept = near_dedup.deduplicated(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 4, 4, 5, 7, 8, 9, None])
    assert near_dedup.near_duplicates(none).count() == 0


def test_darts_estimate_weighted_similarity():
    items = np.arange(1, 401, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    one, two = np.ones(400), np.ones(400)
    one[:60] = 3
    two[300:] = 0
    want = np.minimum(one, two).sum() / np.maximum(one, two).sum()
    rows = np.repeat([0, 1], 400)
    weight = np.concatenate([one, two])
    own = weight > 0
    found = near_dedup.signatures(np.tile(items, 2)[own], rows[own], weight[own], 2, k=4000)
    assert abs((found[0] == found[1]).mean() - want) < 0.03


def test_bpe_equals_the_library(spark, odd, none):
    found = bpe.encoded(odd, PATH, public_tokenizers.PATTERN, keep_ids=True).collect()
    want = Counter()
    for row in odd.collect():
        ids = np.array(ENCODING.encode_ordinary(row.text or ""), "<u4").tobytes()
        want[row.doc_id, len(ids) // 4, ids, hashlib.sha256((row.text or "").encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded_sha256) for r in found) == want
    assert len(LONG) > bpe.CHUNK
    assert bpe.encoded(none, PATH, public_tokenizers.PATTERN).count() == 0


def test_bpe_chunks_resynchronise():
    random.seed(1)
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    letters = "abc é ß'’ \n\t\r\x1c\x85\xa0　​ 12½#!🙂日 tsrvml  LL'S'd're" + " a" * 10 + "z" * 12
    for _ in range(1500):
        text = "".join(random.choice(letters) for _ in range(random.randint(0, 200)))
        size, more = random.choice([7, 16, 40]), random.choice([1, 5, 8])
        starts = range(0, max(1, len(text)), size)
        chunks = [(a, text[a : a + size + more], *bpe.cut_pieces(codec, text[a : a + size + more])) for a in starts]
        want = np.array(ENCODING.encode_ordinary(text), "<u4").tobytes()
        assert bpe.stitched(codec, chunks, size) == want == codec.encode(text)
        assert codec.decode(want) == text.encode()


def test_tokens_met_before_are_remembered(monkeypatch):
    """Units met once don't push out those that are met again; chunks use the memory too; it stays bounded."""
    monkeypatch.setattr(bpe, "CACHED", 50)
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    made, plain = [], codec.encode_piece
    codec.encode_piece = lambda piece: made.append(piece) or plain(piece)
    texts = [" ".join(["zzq", "unfrequented", *[f"{a}zq{b}x" for a in "bcdfgh" for b in "bcdfg"[: k + 1]]]) for k in range(4)]
    texts += [f"unfrequented once{k * 7919}" for k in range(60)]
    for text in texts:
        assert codec.encode(" " + text) == np.array(ENCODING.encode_ordinary(" " + text), "<u4").tobytes()
        assert len(codec.known) < 150
    assert made.count(b" unfrequented") <= 3
    made.clear()
    *_, ids = bpe.cut_pieces(codec, " " + " ".join(["unfrequented"] * 30))
    assert ids == codec.encode(" unfrequented") * 30 and made.count(b" unfrequented") <= 1


def test_long_pieces():
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    for text in ("a" * 5000, "ab" * 3000, "日本" * 2000):
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == ENCODING.encode_ordinary(text)


def test_quality_and_toxicity_on_odd_rows(odd, none, labels):
    for scored in (quality.scored, toxicity.scored):
        found = scored(odd, labels).collect()
        assert Counter(r.doc_id for r in found) == Counter([1, 2, 3, 4, 4, 5, 6, 7, 8, None, 9])
        assert all(0 <= r.score <= 1 for r in found)
        assert scored(none, labels).count() == 0
        assert scored(odd, labels.where("1 = 0")).count() == 11
    assert quality.good(odd, labels).columns == odd.columns


def test_isotonic():
    assert quality.isotonic(np.array([1.0, 3, 2, 2, 5]), np.ones(5)).tolist() == pytest.approx([1, 7 / 3, 7 / 3, 7 / 3, 5])


def test_marginals_equal_all_labellings():
    random = np.random.default_rng(3)
    tagger = toxicity.Tagger(random.normal(0, 1, toxicity.SLOTS + 1), random.normal(0, 1, (2, 2)), random.normal(0, 1, 2))
    slots = random.integers(0, toxicity.SLOTS, (7, toxicity.FEATURES))
    first = np.array([1, 0, 0, 0, 1, 0, 0], bool)
    want = np.zeros(7)
    for a, b in ((0, 4), (4, 7)):
        total, hits = 0.0, np.zeros(b - a)
        for code in range(2 ** (b - a)):
            y = [(code >> t) & 1 for t in range(b - a)]
            score = tagger.start[y[0]] + sum(tagger.move[p, q] for p, q in zip(y, y[1:]))
            score += sum(tagger.weight[slots[a + t]].sum() + tagger.weight[-1] for t in range(b - a) if y[t])
            total += np.exp(score)
            hits += np.exp(score) * np.array(y)
        want[a:b] = hits / total
    assert tagger.marginals(slots, first) == pytest.approx(want)


def test_hamming(spark):
    random = np.random.default_rng(5)
    rows = [(i, random.normal(0, 1, 20).tolist()) for i in range(300)] + [(500 + i, [1.0] * 20) for i in range(30)]
    odd = [(400, None), (401, []), (402, [1.0] * 19), (403, [None] * 20), (404, [float("nan")] * 20), (None, [1.0] * 20)]
    table = spark.createDataFrame(rows + odd + rows[:3], "vec_id bigint, embedding array<double>")
    found = hamming.nearest(table, table.where("vec_id % 20 = 0"), bits=20, k=5).collect()
    codes = {i: np.array(v) > 0 for i, v in rows} | {404: np.zeros(20, bool)}
    got = {}
    for row in found:
        got.setdefault(row.query_id, []).append((row.rank, row.distance, row.vec_id))
    want = {}
    for q in codes:
        if q % 20 == 0:
            near = sorted((int((codes[q] != c).sum()), i) for i, c in codes.items())[:5]
            want[q] = [(rank, d, i) for rank, (d, i) in enumerate(near, 1)]
    assert {q: sorted(x) for q, x in got.items()} == want
    assert hamming.nearest(table.limit(0), table, bits=20).count() == 0


def test_line_rules(odd, none, spark):
    found = line_rules.judged(odd).collect()
    assert len(found) == 11
    by = {r.doc_id: r for r in found}
    assert by[1].kept and not by[1].base_failed and by[1].n_words == 80 and by[1].n_repeat_words == 0
    assert by[4].n_dup_lines == 1 and by[4].n_repeat_words == 120 and by[4].base_failed
    assert by[5].base_failed and by[6].n_words == by[7].n_words == 0 and by[7].cleaned == " \n\t\n "
    assert by[8].n_words == 40_001 and by[8].n_repeat_words == 40_000
    assert line_rules.judged(none).count() == 0
    text = "Home | News | About | Mail\nA good line ends here.\nWe use cookies, see our Privacy Policy.\n#### $$$$ %%%%"
    assert line_rules.judged(spark.createDataFrame([(1, text)], "doc_id int, text string")).first().cleaned == "A good line ends here."


def test_mixing(odd, none, spark):
    found = mixing.mixed(odd).collect()
    assert len(found) == 11 and all(r.taken <= 3 * r["size"] for r in found)
    again = mixing.mixed(odd).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))
    assert mixing.mixture(odd).columns == odd.columns and mixing.mixed(none).count() == 0
    rows = [(i, "a " * (1 + i % 37), ("x", "y", "z", None)[i % 4]) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    taken, target = Counter(), {}
    for r, (_, _, source) in zip(sorted(mixing.mixed(docs).collect(), key=lambda r: r.doc_id), rows):
        taken[source] += r.taken
        target[source] = r.target
    total = sum(1 + i % 37 for i in range(2000))
    assert sum(target.values()) == pytest.approx(total)
    assert target["x"] == pytest.approx(total * 5 / 13) and target["y"] == pytest.approx(total * 2 / 13)
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert mixing.mixture(docs).count() == sum(r.copies for r in mixing.mixed(docs).collect())


def test_lines(odd, none):
    found = {(r.doc_id, r.line): r for r in line_dedup.classified(odd).collect()}
    assert found[1, 0].kept and not found[2, 0].kept and not found[3, 0].kept
    assert found[4, 0].kept and not found[4, 1].kept and (5, 0) not in found and (None, 0) not in found
    clean = line_dedup.cleaned(odd)
    assert clean.columns == odd.columns and clean.count() == 11
    texts = {r.doc_id: r for r in clean.collect()}
    assert texts[2].text == "" and texts[2].n_chars == 0 and texts[5].text is None and texts[7].text == " \n\t\n "
    assert line_dedup.classified(none).count() == 0


def test_lines_that_miss_every_pivot_are_linked(spark):
    """200 variants of one line, two by two just near; all share buckets, so most pairs have no pivot of a bucket in them."""
    draw = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    template = "".join(draw.choices(letters, k=100))
    texts = []
    for _ in range(100):
        joint = "".join(draw.choices(letters, k=2))
        texts += [template + joint + "".join(draw.choices(letters, k=10)) for _ in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    runs = [{x[i : i + 8] for i in range(len(x) - 7)} for x in texts]
    first = list(range(200))
    for i, a in enumerate(runs):
        for j in range(i):
            if len(a & runs[j]) >= 0.8 * len(a | runs[j]):
                first = [first[j] if k == first[i] else k for k in first]
    assert len(set(first)) <= 100
    found = by_id(line_dedup.classified(docs))
    assert [found[i].first_id for i in range(200)] == [first.index(k) for k in first]


def test_passages(odd, none):
    found = by_id(passages.repeated(odd))
    assert len(found) == 10
    assert found[1].spans == found[2].spans == "0:80" and found[3].spans == ""
    assert found[4].spans == "0:120" and found[8].n_repeated_words == 40_000 and found[None].spans == ""
    assert passages.repeated(none).count() == 0


def test_passages_of_many_leads_and_tails(spark):
    """A notice of 45 words with 12 leads and 12 tails of 4 words: only equal lead and tail, or a chance word, make 50."""
    draw = random.Random(9)
    notice = [f"n{i}" for i in range(45)]
    texts = []
    for _ in range(600):
        lead, tail = draw.randrange(12), draw.randrange(12)
        around = [f"w{draw.randrange(200)}" for _ in range(40)]
        texts.append(around[:20] + [f"a{lead}_{k}" for k in range(4)] + notice + [f"b{tail}_{k}" for k in range(4)] + around[20:])
    windows = [[tuple(x[i : i + 50]) for i in range(len(x) - 49)] for x in texts]
    times = Counter(w for x in windows for w in x)
    want = {}
    for i, x in enumerate(windows):
        hits = [k for k, w in enumerate(x) if times[w] > 1]
        want[i] = f"{hits[0]}:{hits[-1] + 50}" if hits else ""
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(texts)], "doc_id bigint, text string")
    assert {i: r.spans for i, r in by_id(passages.repeated(docs)).items()} == want


def test_personal_data(spark, none):
    texts = [
        (1, "é mail a.b@c.org_x@y.net, ip 10.0.0.1 and 10.0.0.256, +49 (30) 1234-5678, 4111 1111 1111 1111, 4111 1111 1111 1112"),
        (2, "bank DE89370400440532013000 and DE89370400440532013001"),
        (3, None),
        (4, "1" * 20_000 + "a" * 20_000),
        (5, "1.2.3.4.5.6.7.8"),
    ]
    found = by_id(personal_data.found(spark.createDataFrame(texts, "doc_id int, text string")).select("doc_id", personal_data.joined("found").alias("s")))
    text = texts[0][1]

    def at(kind, part):
        return f"{kind}:{text.index(part)}:{text.index(part) + len(part)}"

    want = [at("email", "a.b@c.org"), at("email", "_x@y.net"), at("ip", "10.0.0.1"), at("phone", "+49 (30) 1234-5678"), at("card", "4111 1111 1111 1111")]
    assert found[1].s.split(",") == want
    assert found[2].s == "iban:5:27" and found[3].s == "" and found[4].s == "" and found[5].s == "ip:0:7,ip:8:15"
    assert personal_data.found(none).count() == 0


def test_ibans_before_other_words(spark):
    """Whatever follows a blank is no part of an iban; a code without a known length takes in all that may belong to it."""
    grouped, compact, british, other = "DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19", "DZ580002100001113000000570"
    texts = [f"{one}{tail}" for one in (grouped, compact) for tail in (" Please pay", " BIC COBADEFF", " 2024", " 7", ", A", "")]
    texts += [f"{grouped} {british} {compact} {grouped}", f"REF AB12 {grouped} NOW", f"{other} and", f"{grouped}1", f"{grouped[:-1]}1 Please"]
    wanted = [[one] for one in (grouped, compact) for _ in range(6)] + [[grouped, british, compact, grouped], [grouped], [other], [], []]
    found = by_id(personal_data.found(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")))
    for i, text in enumerate(texts):
        assert [text[s.start : s.end] for s in found[i].found if s.kind == "iban"] == wanted[i], text


def test_members_that_miss_every_pivot_are_linked(spark):
    """A bucket of 30 in which only neighbours (0, 1), (2, 3) ... are near: hardly any pair has a pivot."""
    shared = spark.range(30).selectExpr("7L AS band", "id AS rep", "30L AS n")
    links, roots = near_dedup.linked(shared, lambda pairs: pairs.where("a div 2 = b div 2"))
    assert sorted((r.a, r.b) for r in links.collect()) == [(k, k + 1) for k in range(0, 30, 2)]
    assert sorted((r.node, r.root) for r in roots.collect()) == [(k, k - k % 2) for k in range(30)]


def test_sketches_rule_out_no_near_pair(spark):
    """Pairs are ruled out only below the similarity, and of clearly different ones most are; repeated shingles count."""
    pick = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for k in range(400):
        own = list(words[:150] if k % 2 else words[:20] * 6)
        for at in pick.sample(range(len(own)), k // 8):
            own[at] = pick.choice(words)
        texts.append(" ".join(own))
    import pyarrow as pa

    from orestrata.llm import blocks

    data, offsets = blocks.bytes_of(pa.array(texts))
    key, row, count = near_dedup._counted(data, offsets)
    sketch = near_dedup._sketch(key, row, count, len(texts)).to_pylist()
    pairs = [(i, j) for i in range(0, 400, 3) for j in range(1, 400, 7)]
    kind = f"a long, b long, text_a string, text_b string, one {near_dedup.sketch_type(near_dedup.SKETCH)}, two {near_dedup.sketch_type(near_dedup.SKETCH)}"
    df = spark.createDataFrame([(i, j, texts[i], texts[j], sketch[i], sketch[j]) for i, j in pairs], kind)
    near = {(r.a, r.b): r.similarity for r in df.select("a", "b", "text_a", "text_b").mapInArrow(near_dedup._similarities, "a long, b long, similarity double").collect()}
    kept = {(r.a, r.b) for r in df.where(near_dedup.may_be_near("one", "two", near_dedup.SKETCH, 0.8)).collect()}
    assert {p for p, s in near.items() if s >= 0.8} <= kept
    far = [p for p, s in near.items() if s < 0.5]
    assert len(far) > 1000 and len(kept.intersection(far)) < len(far) / 100


def test_left_over_members_meet_only_where_sketches_allow(spark):
    """A bucket of members that are all far from each other: no pair of them is verified, a near one still is linked."""
    shared = spark.createDataFrame([(1, i, 60) for i in range(60)], "band long, rep long, n long")
    words = near_dedup.SKETCH
    rows = [(i, (64, *[1 << (i % 60)] * words)) for i in range(60)]
    rows = [(i, s if i != 41 else rows[17][1]) for i, s in rows]
    rows = [(i, (8, *s[1:])) for i, s in rows]
    sketched = spark.createDataFrame(rows, f"rep long, sketch {near_dedup.sketch_type(words)}")
    seen = []

    def verified(pairs):
        seen.extend((r.a, r.b) for r in pairs.collect())
        return pairs

    links, roots = near_dedup.linked(shared, verified, sketched, words)
    assert set(seen) == {(17, 41)}
    assert {(r.a, r.b) for r in links.collect()} == {(17, 41)} and roots.count() == 2


def test_pipeline_stages(spark):
    """Each stage on all that its predecessor kept: columns stay, documents only go or repeat, ids decode to the texts."""
    import hashlib

    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).checkpoint()
        found = [r.doc_id for r in docs.select("doc_id").collect()]
        assert docs.columns == columns and set(found) <= ids
        assert name == "mix" or len(found) == len(set(found))
        assert name != "lines" or set(found) == ids
        ids = set(found)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    texts = {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in docs.collect()}
    rows = last.select("doc_id", "decoded_sha256").collect()
    assert len(rows) == docs.count() > 0 and all(texts[r.doc_id] == r.decoded_sha256 for r in rows)


def test_pairs_grow_with_the_group(spark):
    """Variants of one text, each near to most others, share 12 bands: each meets a few others, not some in every band."""
    members, bands, seen = 400, 12, []
    buckets = spark.range(members).selectExpr("id AS rep", f"explode(sequence(1L, {bands}L)) AS band", f"{members}L AS n")
    buckets = buckets.where("xxhash64(rep, band) % 4 <> 0")

    def verified(pairs):
        seen.append(pairs.count())
        return pairs.where("(a + b) % 10 <> 0")

    _, roots = near_dedup.linked(buckets, verified)
    assert {r.root for r in roots.collect()} == {0} and roots.count() == members
    assert sum(seen) < 8 * members


def test_components_need_no_smallest_center(spark):
    """Chains, stars around a large node, loops, repeated and null links."""
    rows = [(k, k + 1) for k in range(40)] + [(99, k) for k in range(50, 60)] + [(70, 70), (71, None), (1, 0), (99, 50)]
    found = shared.components(spark.createDataFrame(rows, "a long, b long"), "a", "b").collect()
    wanted = {**{k: 0 for k in range(41)}, **{k: 50 for k in [*range(50, 60), 99]}, 70: 70}
    assert {r.node: r.root for r in found} == wanted and len(found) == len(wanted)
