"""Profiles from mergeable sketches, and foreign keys found over all columns of all tables.

A sketch of a column takes a few kilobytes whatever it has seen, and sketches of parts merge to that of the whole. So a table is
profiled by one scan that shuffles sketches and no values, and a new partition costs its own scan. Only columns whose
estimate comes near their number of rows are counted exactly, since those may be keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.operators.profile import INTEGRAL, column_values

# An estimate of this share of the rows may be a key: several standard errors of the sketch.
NEAR = 0.85
LONG_TEXT = 32
PREFIX = 64
_ATOMIC = ("integral", "string", "double", "float", "date", "timestamp", "timestamp_ntz", "boolean", "decimal")


def kind_of(df: DataFrame, name: str) -> str:
    """Columns are comparable within a kind: whole numbers of any width, or one exact type."""
    type_name = df.schema[name].dataType.simpleString()
    return INTEGRAL if type_name in ("tinyint", "smallint", "int", "bigint") else type_name


def sketched(df: DataFrame, by: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(by, column, records, null_count, sketch): a row for each part and column, by one scan."""
    names = list(columns or [c for c in df.columns if c != by])
    made = []
    for i, name in enumerate(names):
        value = F.col(name).cast("bigint" if kind_of(df, name) == INTEGRAL else "string")
        made += [F.count(value).alias(f"present__{i}"), F.hll_sketch_agg(value).alias(f"sketch__{i}")]
    wide = df.groupBy(by).agg(F.count(F.lit(1)).alias("records"), *made)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                "records",
                (F.col("records") - F.col(f"present__{i}")).alias("null_count"),
                F.col(f"sketch__{i}").alias("sketch"),
            )
            for i, name in enumerate(names)
        ]
    )
    return wide.select(by, F.explode(rows).alias("r")).select(by, "r.*")


def merged(sketches: DataFrame) -> DataFrame:
    """(column, records, null_count, distinct_estimate) of the whole from sketches of its parts."""
    whole = sketches.groupBy("column").agg(
        F.sum("records").alias("records"),
        F.sum("null_count").alias("null_count"),
        F.hll_union_agg("sketch").alias("sketch"),
    )
    return whole.select("column", "records", "null_count", F.hll_sketch_estimate("sketch").alias("distinct_estimate"))


def profile_from(sketches: DataFrame, df: DataFrame, table: str) -> DataFrame:
    """Per column records, nulls, the estimate, and whether it is a key, which is counted exactly where the estimate allows it."""
    found = merged(sketches)
    near = found.where((F.col("null_count") == 0) & (F.col("distinct_estimate") >= F.col("records") * NEAR))
    names = [row["column"] for row in near.select("column").collect()]  # at most one for each column
    if not names:
        keyed = found.withColumn("is_key", F.lit(False))
    else:
        counts = column_values(df, names, hashed=True).groupBy("column").agg(F.count("value").alias("n"))
        keyed = found.join(counts, "column", "left").withColumn("is_key", F.coalesce(F.col("n") == F.col("records"), F.lit(False)))
    keyed = keyed.withColumn("is_key", F.col("is_key") & (F.col("records") > 0))
    return keyed.select(F.lit(table).alias("table_name"), "column", "records", "null_count", "distinct_estimate", "is_key")


def foreign_keys(tables: dict[str, DataFrame], minimum: float = 1.0) -> DataFrame:
    """Columns of any table whose values lie in a key column of another: the whole schema is searched.

    (child_table, child_column, parent_table, parent_column, distinct_values, contained, inclusion).

    Pairs are pruned by one scan of each table: the parent's estimate must be near its rows, the kinds must be the same, the ranges
    must meet, and the parent must have enough values. What is left is decided exactly: values are grouped once, to the set
    of columns that hold them, and then by this set, of which there are few. So no pair of columns costs a row per value.
    """
    with ThreadPoolExecutor(8) as pool:  # many of the scans are small
        stats = dict(zip(tables, pool.map(_statistics, tables.values())))
    pairs = [
        ((child, c), (parent, p))
        for child, own in stats.items()
        for c, a in own.items()
        for parent, theirs in stats.items()
        if parent != child
        for p, b in theirs.items()
        if _possible(a, b, minimum)
    ]
    found = []
    for kind in dict.fromkeys(stats[t][c]["kind"] for (t, c), _ in pairs):
        alike = [pair for pair in pairs if stats[pair[0][0]][pair[0][1]]["kind"] == kind]
        found.append(_contained(tables, alike, kind))
    spark = next(iter(tables.values())).sparkSession
    if not found:
        return spark.createDataFrame([], _FOUND)
    return reduce(DataFrame.unionByName, found).where(F.col("contained") >= F.lit(minimum) * F.col("distinct_values"))


_FOUND = (
    "child_table string, child_column string, parent_table string, parent_column string, distinct_values bigint, "
    "contained bigint, inclusion decimal(5,4)"
)


def _statistics(df: DataFrame) -> dict[str, dict]:
    """Per column its kind, rows, values, estimate and range: one scan, one row."""
    names = [c for c in df.columns if kind_of(df, c).split("(")[0] in _ATOMIC]
    made = [F.count(F.lit(1)).alias("records")]
    for i, name in enumerate(names):
        text = kind_of(df, name) == "string"
        low, high = ((F.substring(f(name), 1, PREFIX) if text else f(name)) for f in (F.min, F.max))
        distinct = F.hll_sketch_estimate(F.hll_sketch_agg(F.when(F.col(name).isNotNull(), F.xxhash64(name))))
        made += [F.count(name).alias(f"present__{i}"), low.alias(f"low__{i}"), high.alias(f"high__{i}"), distinct.alias(f"distinct__{i}")]
    row = df.agg(*made).first()
    keys = ("present", "low", "high", "distinct")
    return {
        name: {"kind": kind_of(df, name), "records": row["records"], **{k: row[f"{k}__{i}"] for k in keys}}
        for i, name in enumerate(names)
    }


def _possible(child: dict, parent: dict, minimum: float) -> bool:
    """Whether the child's values may lie in the parent, a key, as far as statistics tell."""
    if child["kind"] != parent["kind"] or not child["present"] or parent["present"] < parent["records"]:
        return False
    if parent["distinct"] < NEAR * parent["records"] or parent["records"] < minimum * NEAR * child["distinct"]:
        return False
    return child["low"] <= parent["high"] and parent["low"] <= child["high"]


def _contained(tables: dict[str, DataFrame], pairs: list, kind: str) -> DataFrame:
    holders = list(dict.fromkeys(holder for pair in pairs for holder in pair))
    parts = []
    for table in dict.fromkeys(t for t, _ in holders):
        own = {c: i for i, (t, c) in enumerate(holders) if t == table}
        values = [_value(c, kind).alias(c) for c in own]
        long = tables[table].select(*values).unpivot([], list(own), "column", "value")
        number = F.create_map(*[F.lit(x) for item in own.items() for x in item])[F.col("column")]
        parts.append(long.select(number.alias("holder"), "value"))
    # One row for each value of a column, then the set of columns that hold it and those where it repeats.
    held = reduce(DataFrame.unionByName, parts).groupBy("holder", "value").agg(F.count(F.lit(1)).alias("n"))
    many = F.when((F.col("n") > 1) | F.col("value").isNull(), F.col("holder"))
    sets = held.groupBy("value").agg(
        F.sort_array(F.collect_list(F.when(F.col("value").isNotNull(), F.col("holder")))).alias("held_by"),
        F.sort_array(F.collect_list(many)).alias("broken"),
    )
    sets = sets.groupBy("held_by", "broken").agg(F.count(F.lit(1)).alias("n"))
    broken = sets.select(F.explode("broken").alias("parent")).distinct()
    sizes = sets.select(F.explode("held_by").alias("child"), "n").groupBy("child").agg(F.sum("n").alias("distinct_values"))
    numbers = {holder: i for i, holder in enumerate(holders)}
    asked = F.array(*[F.struct(F.lit(numbers[a]).alias("child"), F.lit(numbers[b]).alias("parent")) for a, b in pairs])
    met = sets.select("n", "held_by", F.explode(asked).alias("p")).where(
        F.array_contains("held_by", F.col("p.child")) & F.array_contains("held_by", F.col("p.parent"))
    )
    counted = met.groupBy("p.child", "p.parent").agg(F.sum("n").alias("contained"))
    keyed = counted.join(broken, "parent", "left_anti").join(sizes, "child")

    def name_of(number: str, part: int) -> Column:
        return F.element_at(F.array(*[F.lit(holder[part]) for holder in holders]), F.col(number) + 1)

    return keyed.select(
        name_of("child", 0).alias("child_table"),
        name_of("child", 1).alias("child_column"),
        name_of("parent", 0).alias("parent_table"),
        name_of("parent", 1).alias("parent_column"),
        "distinct_values",
        "contained",
        (F.col("contained") / F.col("distinct_values")).cast("decimal(5,4)").alias("inclusion"),
    )


def _value(name: str, kind: str) -> Column:
    """What stands for a value: long texts by their digest, so that no document is shuffled."""
    if kind == INTEGRAL:
        return F.col(name).cast("bigint")
    if kind == "string":
        return F.when(F.length(name) > LONG_TEXT, F.sha2(F.col(name), 256)).otherwise(F.col(name))
    return F.col(name)
