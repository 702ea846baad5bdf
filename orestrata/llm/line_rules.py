"""Quality rules, line first (operator 5). DataFrame functions only.

Each line is judged by itself; lines that fail are removed, and a document that loses too much of its text is
rejected. A line without a word is neither kept nor lost. A line with words fails as

- `navigation`: it has three or more of the separators | » › •, and one for every three words at least;
- `boilerplate`: it holds one of the phrases of `BOILERPLATE`, in any case;
- `punctuation`: characters of `SYMBOLS` are a tenth or more of what is not blank, or it has no sentence end (one of
  `_ENDS`, closing quotes and brackets aside) although it has ten words or more.

The first that holds is its verdict. Besides, base rules over the whole document: fewer than 20 words, or more than
30 % of the words inside windows of eight words that occur twice or more in the document, reject it at once.

Scale: one row in, one row out, no shuffle; the cost is in proportion to the text (n log n in its words for the
windows, which are compared by 64-bit hashes).

Edge cases: a null text has no lines and no words, and is rejected (base_failed); empty texts too. Rows that share an
id are judged each by itself. An empty table gives an empty result. Other columns are never read by `judged`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.llm.shared import BLANKS

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
MAX_LOST = 0.5  # share of the characters in words

# Phrases of page furniture, in lower case.
BOILERPLATE = [
    "accept cookies",
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "javascript is disabled",
    "lorem ipsum",
    "privacy policy",
    "sign up for our newsletter",
    "skip to content",
    "subscribe to our",
    "terms of service",
    "terms of use",
    "this site uses cookies",
]

_BLANK = r"[\x20\x09-\x0D]+"
_SEPARATORS = "|»›•"
_ENDS = [".", "!", "?", "…", ":", ";", "。", "！", "？"]
_CLOSING = "\"'”’»)]*"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed != "", F.split(trimmed, _BLANK)).otherwise(F.array().cast("array<string>"))


def word_chars(text: Column) -> Column:
    """Characters that are in words."""
    return F.length(F.regexp_replace(text, _BLANK, "")).cast("long")


def occurrences(text: Column, characters: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{characters}]")).cast("long")


def blank(line: Column) -> Column:
    return F.ltrim(line, F.lit(BLANKS)) == ""


def repeated_words(found: Column) -> Column:
    """How many words lie in a window of WINDOW words that occurs twice or more; `found` is an array of words."""
    starts = F.sequence(F.lit(0), F.size(found) - WINDOW)
    hashed = F.transform(found, lambda x: F.xxhash64(x))

    def windows(of: Column) -> Column:
        return F.transform(starts, lambda i: F.xxhash64(F.slice(of, i + 1, F.lit(WINDOW))))

    covered = let(let(hashed, windows), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h)).otherwise(F.lit(0)))
    return F.when(F.size(found) > WINDOW, covered).otherwise(F.lit(0)).cast("long")


def _covered(hashes: Column) -> Column:
    """Positions sorted by hash have their twins next to them; windows of twins, in order of position, add the
    words that the one before doesn't hold."""
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(pairs: Column) -> Column:
        edge = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
        before = F.concat(edge, F.slice(pairs, F.lit(1), F.size(pairs) - 1))
        after = F.concat(F.slice(pairs, F.lit(2), F.size(pairs) - 1), edge)
        marked = F.zip_with(before, after, lambda b, a: F.struct(b["h"].alias("b"), a["h"].alias("a")))
        marked = F.zip_with(
            pairs, marked, lambda x, m: F.when((x["h"] == m["b"]) | (x["h"] == m["a"]), x["i"])
        )
        return F.array_sort(F.filter(marked, lambda i: i.isNotNull()))

    def total(at: Column) -> Column:
        n = F.size(at)
        gaps = F.zip_with(F.slice(at, F.lit(2), n - 1), F.slice(at, F.lit(1), n - 1), lambda b, a: F.least(b - a, F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(WINDOW), lambda s, x: s + x)

    return let(let(ordered, starts), total)


def verdict(line: Column) -> Column:
    """The rule that a line fails by, `blank` for one without words, null for a good line."""
    solid = word_chars(line)
    size = F.length(line)  # words, or a few more:
    count = 2 * size - F.length(F.replace(line, F.lit(" "), F.lit(""))) - F.length(F.replace(line, F.lit("\t"), F.lit(""))) + 1
    symbols = occurrences(line, SYMBOLS)
    bars = occurrences(line, _SEPARATORS)
    lowered = F.lower(line)
    furniture = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(x)) for x in BOILERPLATE])
    end = F.substring(F.rtrim(line, F.lit(BLANKS + _CLOSING)), -1, 1)
    return (
        F.when(blank(line), "blank")
        .when((bars >= 3) & (bars * 3 >= count), "navigation")
        .when(furniture, "boilerplate")
        .when((symbols > 0) & (symbols * 10 >= solid), "punctuation")
        .when((count >= 10) & ~end.isin(_ENDS), "punctuation")
    )


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of `docs`: id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, lost (share of the characters in words), kept, cleaned (the text without failed lines)."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("repeated"))

    def of_lines(lines: Column) -> Column:
        full = F.filter(lines, lambda x: ~blank(x))
        copies = let(full, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
        good = F.filter(lines, lambda x: F.coalesce(verdict(x), F.lit("blank")) == "blank")
        return F.struct(copies.alias("copies"), F.array_join(good, "\n").alias("cleaned"))

    found = rows.select(
        "id",
        let(words(F.col("text")), of_words).alias("w"),
        let(F.split("text", "\n"), of_lines).alias("l"),
        word_chars(F.col("text")).alias("word_chars"),
        occurrences(F.col("text"), SYMBOLS).alias("n_symbols"),
    )
    failed = (F.col("w.n") < MIN_WORDS) | (100 * F.col("w.repeated") > MAX_REPEATED_PERCENT * F.col("w.n"))
    lost = F.when(F.col("word_chars") > 0, 1 - word_chars(F.col("l.cleaned")) / F.col("word_chars")).otherwise(0.0)
    return found.select(
        F.col("id").alias(id_col),
        F.col("w.n").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("l.copies").alias("n_dup_lines"),
        F.col("w.repeated").alias("n_repeat_words"),
        failed.alias("base_failed"),
        lost.alias("lost"),
        (~failed & (lost <= MAX_LOST)).alias("kept"),
        F.col("l.cleaned").alias("cleaned"),
    )
