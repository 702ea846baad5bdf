"""The mix against its definition, and against a solver of its own on small tables."""

import math
from collections import Counter, defaultdict

import pytest

from orestrata.llm import mixing

COLUMNS = "doc_id bigint, text string, source string"


def targets(sizes):
    """Targets by the definition: weights 5, 2, 1 in order of the names, stopped at 3 times the source's size."""
    names = sorted(sizes, key=lambda x: (x is None, x or ""))
    weight = {name: (5, 2, 1)[i % 3] for i, name in enumerate(names)}
    left, found = float(sum(sizes.values())), {}
    while True:
        open_ = [n for n in names if n not in found]
        total = sum(weight[n] for n in open_)
        over = [n for n in open_ if left * weight[n] / total > 3 * sizes[n]]
        if not over:
            return {**found, **{n: left * weight[n] / total for n in open_}}
        for n in over:
            found[n] = 3.0 * sizes[n]
        left = sum(sizes.values()) - sum(found.values())


def rates(sizes, target):
    """Copies per document as they are before rounding: the tilt is solved by bisection."""
    mean = sum(sizes) / len(sizes)
    low, high = -60.0, 60.0
    for _ in range(300):
        tilt = (low + high) / 2
        words = sum(z * min(3.0, math.exp(min(tilt * z / mean, 50.0))) for z in sizes)
        low, high = (tilt, high) if words < target else (low, tilt)
    return [min(3.0, math.exp(min(tilt * z / mean, 50.0))) for z in sizes]


def mix(spark, rows):
    found = mixing.mixed(spark.createDataFrame(rows, COLUMNS)).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    own = dict(zip([r[0] for r in rows], [r[2] for r in rows]))
    for r in found:
        source = own[r.doc_id]
        sizes[source] += r["size"]
        taken[source] += r.taken
        target[source] = r.target
        assert r.taken <= 3 * r["size"] and r.taken % max(r["size"], 1) == 0
    return found, sizes, taken, target


def test_equals_a_plain_solver(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 90)), ("a", "b", "c", None)[i % 4 if i % 5 else 0]) for i in range(400)]
    found, sizes, taken, target = mix(spark, rows)
    want = targets(sizes)
    by_size = defaultdict(list)
    for r in found:
        by_size[dict((x[0], x[2]) for x in rows)[r.doc_id]].append((r["size"], r.copies))
    for source, own in by_size.items():
        assert target[source] == pytest.approx(want[source])
        assert abs(taken[source] - want[source]) <= max(z for z, _ in own)
        # Short and long halves of a source take what the tilt says, but for the carried rounding.
        rate = rates([z for z, _ in own], want[source])
        middle = sorted(z for z, _ in own)[len(own) // 2]
        expected = sum(z * r for (z, _), r in zip(own, rate) if z >= middle)
        assert abs(sum(z * c for z, c in own if z >= middle) - expected) <= 2 * max(z for z, _ in own)


def test_equal_rows_meet_the_target_too(spark):
    """300 rows of one id and text, in one source with others beside it."""
    rows = [(7, "same words in every row here ok", "a")] * 300 + [(1000 + i, "one two three " * 40, "b") for i in range(30)]
    found, sizes, taken, target = mix(spark, rows)
    for source in sizes:
        longest = max(r["size"] for r in found if dict((x[0], x[2]) for x in rows)[r.doc_id] == source)
        assert abs(taken[source] - target[source]) <= longest
    frame = spark.createDataFrame(rows, COLUMNS).repartition(5)
    copies = Counter(r.source for r in mixing.mixture(frame).collect())
    assert copies["a"] * 7 == taken["a"] and copies["b"] * 120 == taken["b"]
    again = mixing.mixed(frame)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, found))
