"""Text normalization."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(name: str) -> Column:
    """Strip spaces only; a tab stays, as in SQL `trim`."""
    return F.trim(F.col(name))


def lowered(name: str) -> Column:
    return F.lower(trimmed(name))


def uppered(name: str) -> Column:
    return F.upper(trimmed(name))


def joined(separator: str, *names: str) -> Column:
    """SQL `a || sep || b`: null if any part is null (unlike concat_ws)."""
    parts: list[Column] = []
    for position, name in enumerate(names):
        if position:
            parts.append(F.lit(separator))
        parts.append(F.col(name).cast("string"))
    return F.concat(*parts)


# What surrounds a value in hand-written files: blanks, line ends, control separators.
_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def stripped(value: Column) -> Column:
    """Strip every kind of white space at both ends."""
    return F.regexp_replace(value, _EDGES, "")
