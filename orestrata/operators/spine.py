"""Gap-free calendar and metrics laid onto it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bounds of the standard calendar.
FIRST_DAY = date(2025, 1, 1)
LAST_DAY = date(2026, 12, 31)


def time_spine(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    """One row per day, both bounds included."""
    return spark.range(1).select(_days(F.lit(first), F.lit(last)).alias("date_day"))


def spine_of(df: DataFrame, day: str) -> DataFrame:
    """One row per day from the first to the last date in `df`."""
    bounds = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return bounds.select(_days(F.col("first"), F.col("last")).alias("date_day"))


def on_spine(spine: DataFrame, metrics: DataFrame, day: str, fill: list[str]) -> DataFrame:
    """Metrics per day with the empty days shown; `fill` columns are 0 there."""
    joined = spine.select("date_day").join(metrics.withColumnRenamed(day, "date_day"), "date_day", "left")
    return joined.withColumns(
        {name: F.coalesce(F.col(name), F.lit(0).cast(metrics.schema[name].dataType)) for name in fill}
    )


def on_group_spine(
    metrics: DataFrame, groups: DataFrame, day: str, first: date, last: date, fill: list[str]
) -> DataFrame:
    """Metrics per group and day with every day from `first` to `last` shown for every row of `groups`.

    Each group's row is exploded into its own days: no cross join, and the days meet the metrics by group and day.
    """
    keys = groups.columns
    dense = groups.distinct().select(*keys, _days(F.lit(first), F.lit(last)).alias(day))
    joined = dense.join(metrics, [*keys, day], "left")
    return joined.withColumns(
        {name: F.coalesce(F.col(name), F.lit(0).cast(metrics.schema[name].dataType)) for name in fill}
    )


def _days(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first, last, F.expr("interval 1 day")))
