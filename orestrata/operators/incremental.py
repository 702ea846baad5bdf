"""Incremental loads: only rows past the target's high-water mark, merged by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def high_water_mark(target: DataFrame, column: str):
    """Largest value already loaded, null for an empty target."""
    return target.agg(F.max(column)).first()[0]


def newer_than(source: DataFrame, target: DataFrame | None, column: str) -> DataFrame:
    """Rows to load: all on the first run, then those past the mark.

    The mark is one value, put into the filter as a literal so that it reaches the file scan.
    """
    if target is None:
        return source
    mark = high_water_mark(target, column)
    if mark is None:
        return source
    kind = target.schema[column].dataType
    return source.where(F.col(column) > F.lit(mark).cast(kind))


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by `order`.

    Spark keeps one row per key in every task before the shuffle, so a key with very many rows sends
    at most one row per task. `order` should be unique within a key, else a tie is broken arbitrarily.
    """
    ranked = W.partitionBy(*keys).orderBy(*[F.desc(name) for name in order])
    return df.withColumn("__rank", F.row_number().over(ranked)).where("__rank = 1").drop("__rank")


def merge_by_key(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Target with the changes applied: the last change of a key replaces the target's row."""
    last = latest_per_key(changes, keys, order).select(*target.columns)
    return target.join(last.select(*keys), keys, "left_anti").unionByName(last)
