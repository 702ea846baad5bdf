"""Text rows checked against a contract: good rows typed, the others kept with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orestrata.functions.text import stripped

REASON = "reject_reason"

# Number texts that are accepted; digits may be grouped by single underscores.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_INTEGER = rf"^[+-]?{_DIGITS}$"
_NUMBER = rf"^[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
_SPECIAL = r"(?i)^[+-]?(?:inf|infinity|nan)$"
# Texts that mean true; any other text is false.
TRUE_TEXTS = ("1", "true", "yes")


def _typed(text: Column, kind: T.DataType) -> Column:
    plain = F.regexp_replace(text, "_", "")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        # "1.0" and "1e3" are whole numbers too: read as float, cut toward zero.
        floating = text.contains(".") | F.lower(text).contains("e")
        cut = F.when(text.rlike(_NUMBER), plain.try_cast("double").try_cast(kind))
        whole = F.when(text.rlike(_INTEGER), plain.try_cast(kind))
        return F.when(floating, cut).otherwise(whole)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(text.rlike(_NUMBER) | text.rlike(_SPECIAL), plain.try_cast(kind))
    if isinstance(kind, T.BooleanType):
        return F.lower(text).isin(*TRUE_TEXTS)
    if isinstance(kind, T.StringType):
        return text
    return text.try_cast(kind)


def coerce(rows: DataFrame, contract: T.StructType) -> DataFrame:
    """All rows, columns typed as in `contract`, plus `reject_reason` (null for good rows).

    Cells are stripped. An empty cell is null where the contract allows it, else rejects the row;
    a cell that does not parse rejects the row. A column missing from `rows` counts as empty.
    The reason names the first bad column in contract order.
    """
    have = set(rows.columns)
    texts, values, reasons = {}, [], []
    for wanted in contract.fields:
        raw = F.col(wanted.name).cast("string") if wanted.name in have else F.lit("")
        texts[f"__{wanted.name}"] = stripped(F.coalesce(raw, F.lit("")))
    prepared = rows.select(*[text.alias(name) for name, text in texts.items()])
    for wanted in contract.fields:
        text = F.col(f"__{wanted.name}")
        empty = text == ""
        value = F.when(~empty, _typed(text, wanted.dataType))
        values.append(value.alias(wanted.name))
        if not wanted.nullable:
            reasons.append(F.when(empty, F.lit(f"{wanted.name}: required but empty")))
        reasons.append(
            F.when(~empty & value.isNull(), F.lit(f"{wanted.name}: not a {wanted.dataType.simpleString()}"))
        )
    return prepared.select(*values, F.coalesce(*reasons).alias(REASON))


def accepted(coerced: DataFrame) -> DataFrame:
    return coerced.where(F.col(REASON).isNull()).drop(REASON)


def rejected(coerced: DataFrame) -> DataFrame:
    return coerced.where(F.col(REASON).isNotNull())


def outcome(coerced: DataFrame) -> DataFrame:
    """One row: how many rows were produced and how many skipped."""
    return coerced.agg(
        F.count_if(F.col(REASON).isNull()).alias("produced"),
        F.count_if(F.col(REASON).isNotNull()).alias("skipped"),
    )
