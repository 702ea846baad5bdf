"""Months, grains and the ISO text form of dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month", "quarter", "year")


def month_start(day: str | Column) -> Column:
    return F.trunc(_col(day), "month")


def month_ordinal(day: str | Column) -> Column:
    """Months since January 1970."""
    column = _col(day)
    return (F.year(column) - 1970) * 12 + F.month(column) - 1


def ordinal_label(ordinal: str | Column) -> Column:
    """Months since January 1970 -> YYYY-MM."""
    column = _col(ordinal)
    year = F.lit(1970) + F.floor(column / 12).cast("int")
    month = F.pmod(column, F.lit(12)) + 1
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def at_grain(day: str | Column, grain: str) -> Column:
    """First date of the period."""
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}, expected one of {GRAINS}")
    column = _col(day)
    return column if grain == "day" else F.trunc(column, grain)


def batch_label(prefix: str, at: Column) -> Column:
    """Scheduled batch id: <prefix>_yyyyMMdd_HHmm."""
    return F.concat(F.lit(prefix), F.lit("_"), F.date_format(at, "yyyyMMdd_HHmm"))


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
