"""Data tests: not null, unique, relationships, accepted values; results as rows.

A test counts its failing rows (or groups) and passes with 0; data is never changed. Keys and values
are grouped before they are shuffled or joined, so a key that fills a third of a table is one row by
then.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orestrata.operators.reports import row_count


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str


@dataclass(frozen=True)
class Unique:
    table: str
    column: str


@dataclass(frozen=True)
class Relationship:
    table: str
    column: str
    to_table: str
    to_column: str


@dataclass(frozen=True)
class AcceptedValues:
    table: str
    column: str
    values: tuple[str, ...]


Test = NotNull | Unique | Relationship | AcceptedValues


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, failures) of many columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.unpivot([], list(columns), "column", "failures")


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows; null keys do not count."""
    return df.dropna(subset=list(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Foreign keys without a parent and the number of child rows that hold them."""
    held = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return held.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def unaccepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list and their number of rows; nulls are not judged."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.where(~F.col(column).isin(*values))


def run_tests(tables: dict[str, DataFrame], tests: Sequence[Test]) -> DataFrame:
    """One row per test: (test, table_name, column, failures, status), run as one job.

    Every table is read once: the columns that its tests need are laid out as (tag, value) and merged to one row for
    each value with its number of rows. All tests are sums over these rows; relationships meet their parent's values in one
    more grouping by value. A column that is only tested for nulls has two values, null or not.
    """
    grouped = _key_values(tables, tests)
    held = F.col("whole").isNotNull() | F.col("value").isNotNull()
    one = grouped.groupBy("tag").agg(
        F.coalesce(F.sum(F.when(~held, F.col("n"))), F.lit(0)).alias("not_null"),
        F.count_if(held & (F.col("n") > 1)).alias("unique"),
        F.count_if(_unaccepted(tests)).alias("accepted_values"),
    )
    # Names come behind the grouping: rows carry a number for their table and column.
    names = F.array(*[F.struct(F.lit(i).alias("tag"), F.lit(t).alias("table_name"), F.lit(c).alias("column")) for (t, c), i in _tags(tests).items()])
    one = one.join(grouped.sparkSession.range(1).select(F.explode(names).alias("t")).select("t.*"), "tag")
    wide = one.unpivot(["table_name", "column"], ["not_null", "unique", "accepted_values"], "test", "failures")
    names = {NotNull: "not_null", Unique: "unique", AcceptedValues: "accepted_values"}
    alone = [F.struct(*map(F.lit, (names[type(t)], t.table, t.column))) for t in tests if not isinstance(t, Relationship)]
    parts = []
    if alone:
        asked = F.struct("test", "table_name", "column")
        # A table without rows has no values, so no failures either: its tests come from the list.
        listed = tables[tests[0].table].sparkSession.range(1).select(F.explode(F.array(*alone)).alias("t"))
        listed = listed.select(F.col("t.col1").alias("test"), F.col("t.col2").alias("table_name"), F.col("t.col3").alias("column"))
        counted = wide.where(asked.isin(*alone))
        parts.append(
            listed.join(counted, ["test", "table_name", "column"], "left").withColumn("failures", F.coalesce("failures", F.lit(0)))
        )
    links = [t for t in tests if isinstance(t, Relationship)]
    if links:
        parts.append(_lost(grouped, links, _tags(tests)))
    return (
        reduce(DataFrame.unionByName, parts)
        .select("test", "table_name", "column", F.col("failures").cast("bigint").alias("failures"))
        .withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL"))
    )


def _tags(tests: Sequence[Test]) -> dict[tuple[str, str], int]:
    """A number for every (table, column) that a test needs."""
    asked = [pair for t in tests for pair in ((t.table, t.column), *([(t.to_table, t.to_column)] if isinstance(t, Relationship) else []))]
    return {pair: i for i, pair in enumerate(dict.fromkeys(asked))}


def _whole_numbers(tables: dict[str, DataFrame], tests: Sequence[Test]) -> set[tuple[str, str]]:
    """The columns whose values can be compared as 64-bit numbers, on both sides of their relationships; the others are compared as text."""
    kinds = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    found = {(t, c) for t, c in _tags(tests) if isinstance(tables[t].schema[c].dataType, kinds)}
    found -= {(t.table, t.column) for t in tests if isinstance(t, AcceptedValues)}
    links = [{(t.table, t.column), (t.to_table, t.to_column)} for t in tests if isinstance(t, Relationship)]
    while mixed := [pair for pair in links if pair & found and not pair <= found]:
        found -= set().union(*mixed)
    return found


def _key_values(tables: dict[str, DataFrame], tests: Sequence[Test]) -> DataFrame:
    """(tag, whole, value, n) of every column that a test needs, each table read once; a value is a whole number or a text."""
    tags, numbers = _tags(tests), _whole_numbers(tables, tests)
    counted = {(t.table, t.column) for t in tests if not isinstance(t, NotNull)}
    counted |= {(t.to_table, t.to_column) for t in tests if isinstance(t, Relationship)}
    long = []
    for name in dict.fromkeys(t for t, _ in tags):
        cells = []
        for (table, column), tag in tags.items():
            if table == name:
                value = F.col(column) if (table, column) in counted else F.when(F.col(column).isNotNull(), 0)
                text = F.lit(None).cast("string")
                if (table, column) not in counted or (table, column) in numbers:
                    whole = value.cast("bigint")
                else:
                    whole, text = F.lit(None).cast("bigint"), value.cast("string")
                cells.append(F.struct(F.lit(tag).alias("tag"), whole.alias("whole"), text.alias("value")))
        long.append(tables[name].select(F.explode(F.array(*cells)).alias("c")).select("c.*"))
    return reduce(DataFrame.unionByName, long).groupBy("tag", "whole", "value").agg(F.count(F.lit(1)).alias("n"))


def _unaccepted(tests: Sequence[Test]) -> Column:
    bad, tags = F.lit(False), _tags(tests)
    for test in tests:
        if isinstance(test, AcceptedValues):
            here = F.col("tag") == tags[test.table, test.column]
            bad = bad | (here & F.col("value").isNotNull() & ~F.col("value").isin(*test.values))
    return bad


def _lost(grouped: DataFrame, links: Sequence[Relationship], tags: dict[tuple[str, str], int]) -> DataFrame:
    """Failures of relationships: rows whose value its parent column lacks.

    Values are picked with their count at hand, which is at least 1: by the value alone they would be picked before the grouping, which
    then is another one than that of the other tests, and all tables would be read and exchanged a second time.
    """
    held = (F.col("whole").isNotNull() | F.col("value").isNotNull()) & (F.col("n") > 0)
    plays: dict[int, list[Column]] = {}
    for i, t in enumerate(links):
        for column, parent in (((t.table, t.column), False), ((t.to_table, t.to_column), True)):
            plays.setdefault(tags[column], []).append(F.struct(F.lit(i).alias("link"), F.lit(parent).alias("parent")))
    roles = F.create_map(*[x for tag, own in plays.items() for x in (F.lit(tag), F.array(*own))])
    met = grouped.select("whole", "value", "n", F.explode(F.when(held, roles[F.col("tag")])).alias("r")).groupBy("r.link", "whole", "value").agg(
        F.sum(F.when(~F.col("r.parent"), F.col("n"))).alias("rows"), F.bool_or("r.parent").alias("known")
    )
    counted = met.groupBy("link").agg(F.sum(F.when(~F.col("known"), F.col("rows"))).alias("failures"))
    names = F.array(*[F.struct(F.lit(i).alias("link"), F.lit(t.table).alias("table_name"), F.lit(t.column).alias("column")) for i, t in enumerate(links)])
    listed = grouped.sparkSession.range(1).select(F.explode(names).alias("t")).select("t.*")
    return listed.join(counted, "link", "left").select(
        F.lit("relationships").alias("test"), "table_name", "column", F.coalesce("failures", F.lit(0)).alias("failures")
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of every table."""
    return reduce(DataFrame.unionByName, [row_count(df, table_name=name) for name, df in tables.items()])
