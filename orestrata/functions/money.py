"""Exact money: decimals end to end, each line rounded half up before it is summed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DISCOUNT = T.DecimalType(5, 2)
PRICE = T.DecimalType(12, 2)
AMOUNT = T.DecimalType(14, 2)
REPORT = T.DecimalType(18, 2)
# Totals over very many lines pass the 12 integer digits of AMOUNT; sum(AMOUNT) has this type.
WIDE = T.DecimalType(24, 2)


def gross(quantity: str | Column, price: str | Column) -> Column:
    return (_col(quantity) * _col(price)).cast(AMOUNT)


def net(quantity: str | Column, price: str | Column, discount: str | Column) -> Column:
    return (_col(quantity) * _col(price) * (F.lit(1) - _col(discount))).cast(AMOUNT)


def total(amount: str | Column, as_type: T.DecimalType = AMOUNT) -> Column:
    return F.sum(amount).cast(as_type)


def per_unit(amount: Column, units: Column) -> Column:
    """Average rounded to cents; null where there are no units."""
    return (amount / F.nullif(units, F.lit(0).cast("bigint"))).cast(AMOUNT)


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
