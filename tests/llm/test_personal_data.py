"""Base kinds against a plain scanner, odd rows, and the time of long texts."""

import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from orestrata.llm import personal_data
from orestrata.llm.queries import QUERIES

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def valid(kind, span):
    digits = re.sub("[^0-9]", "", span)
    if kind == "ip":
        return all(int(p) <= 255 for p in span.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    found = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            if valid(kind, m.group()):
                found.append((m.start(), order, kind, m.end()))
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found))


def texts():
    dice = random.Random(9)
    parts = [
        "a.b@c.de", "x@y", "@", "é@ü.de q@w.e.r", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112",
        "79927398713", "+49 (30) 123-4567", "+1 2", "+12345678901234567", "mail", " call ", "visa", "🙂", "\n", "  ", "12", "0", "-", ".",
        "DE89 3704 0044 0532 0130 00", "9" * 19, "1" * 40, "word",
    ]
    made = ["".join(dice.choice(parts) + dice.choice(["", " ", " ", "\n"]) for _ in range(dice.randint(0, 40))) for _ in range(400)]
    return [*made, "4111111111111111 " * 700, "1.2.3.4 " * 500, "a@b.cd " * 400 + "+49 30 1234567 " * 300]


def test_base_spans_equal_a_plain_scanner(spark):
    every = texts()
    frame = spark.createDataFrame(list(enumerate(every)), "doc_id int, text string").repartition(8)
    base = F.filter("found", lambda s: s["order"] < 4)
    rows = personal_data.found(frame).select("doc_id", personal_data.joined(base).alias("base")).collect()
    assert len(rows) == len(every)
    for row in rows:
        assert row.base == plain(every[row.doc_id]), every[row.doc_id][:200]


def test_odd_rows(spark, odd, none):
    found = personal_data.found(odd)
    assert found.columns == ["doc_id", "found"] and found.count() == 11
    assert found.where(F.size("found") > 0).count() == 0
    assert personal_data.found(none).count() == 0


def test_time_grows_with_the_length(spark):
    def seconds(n):
        frame = spark.createDataFrame([(1, " ".join(f"{10000 + i % 90000}," for i in range(n)) + " x4111111111111111, 1.2.3.4 y" * (n // 20))], "doc_id int, text string")
        started = time.perf_counter()
        row = personal_data.found(frame).select(F.size("found")).first()
        assert row[0] >= n // 10
        return time.perf_counter() - started

    seconds(200)
    small, large = seconds(4_000), seconds(64_000)
    assert large < 6 * 16 * max(small, 0.2)
    assert large < 60


def test_query_counts_and_digests(spark):
    row = QUERIES["op10_personal_data"](spark, "/root/testdata/sf0.001").where("n_email > 0").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(F.col("doc_id") == row.doc_id).first().text
    assert row.base_sha256 == hashlib.sha256(plain(text).encode()).hexdigest()
