import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, size int, bands int, text_a string"
LONG = "wort " * 40_000 + "x" * 60_000


def _row(doc_id, text, source="s"):
    return (doc_id, text, None, source, None if text is None else len(text), "clash", 7, 8, "clash")


@pytest.fixture(scope="package")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, ties, and columns named like inner ones."""
    words = " ".join(f"w{i}" for i in range(80)) + "."
    other = " ".join(f"v{i}" for i in range(60)) + "."
    rows = [
        _row(1, words),
        _row(2, words),
        _row(3, words.replace("w40 ", "changed ")),
        _row(4, other + "\n" + other),
        _row(4, other + "\n" + other),
        _row(5, None),
        _row(6, ""),
        _row(7, " \n\t\n "),
        _row(8, LONG, None),
        _row(None, words, None),
        _row(9, "few words", "t"),
    ]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="package")
def none(spark):
    return spark.createDataFrame([], COLUMNS)
