"""Column profiles, key candidates and quality scores.

Exact distinct counts of many columns are taken in long form: (column, value) pairs are merged in
every task, shuffled once, and each pair is one row from then on, however often it occurs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orestrata.operators.governance import DataClass, class_for

PERCENT = "decimal(5,2)"
INTEGRAL = "integral"


def column_values(df: DataFrame, columns: Sequence[str], hashed: bool = False) -> DataFrame:
    """(column, value, n): each distinct value of each column, null included.

    Whole numbers stay numbers when all columns are; otherwise values are text, with
    `hashed` the SHA-256 of every text, so that whole documents are not shuffled to count them.
    """
    names = list(columns)
    if all(_kind(df, name) == INTEGRAL for name in names):
        wide = df.select(*[F.col(name).cast("bigint").alias(name) for name in names])
    else:
        texts = {name: F.col(name).cast("string") for name in names}
        wide = df.select(*[(F.sha2(text, 256) if hashed else text).alias(name) for name, text in texts.items()])
    return wide.unpivot([], names, "column", "value").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def _by_kind(df: DataFrame, columns: Sequence[str]) -> list[list[str]]:
    """Columns of whole numbers, and the others: the first are cheaper to shuffle."""
    whole = [name for name in columns if _kind(df, name) == INTEGRAL]
    return [names for names in (whole, [name for name in columns if name not in whole]) if names]


def profile(df: DataFrame, table: str, columns: Sequence[str] | None = None, hashed: bool = False) -> DataFrame:
    """Per column: type, records, nulls, distinct values; `hashed` for tables of long texts."""
    type_names = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = []
    for names in _by_kind(df, columns or df.columns):
        counts.append(
            column_values(df, names, hashed)
            .groupBy("column")
            .agg(
                F.sum("n").alias("records"),
                F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
                F.count("value").alias("distinct_count"),
            )
            .select(
                F.lit(table).alias("table_name"),
                "column",
                _lookup(F.col("column"), {name: type_names[name] for name in names}).alias("data_type"),
                "records",
                "null_count",
                "distinct_count",
            )
        )
    return reduce(DataFrame.unionByName, counts)


def primary_keys(profiles: DataFrame) -> DataFrame:
    """Columns that are never null and never repeat."""
    unique = (F.col("null_count") == 0) & (F.col("distinct_count") == F.col("records")) & (F.col("records") > 0)
    return profiles.where(unique).select("table_name", "column", "records")


def foreign_keys(tables: dict[str, DataFrame], columns: dict[str, list[str]], minimum: float = 1.0) -> DataFrame:
    """Columns whose values lie in a key column of another table.

    (child_table, child_column, parent_table, parent_column, distinct_values, contained, inclusion).
    Every table is read once: its distinct values are grouped by value, and each value counts for the
    pairs of columns that hold it. A value is held at most once per candidate column, so a group is no
    larger than the list of candidates.
    """
    kinds = dict.fromkeys(_kind(tables[name], column) for name, names in columns.items() for column in names)
    found = []
    for kind in kinds:
        # Only columns of one kind can contain each other.
        alike = {
            name: [column for column in names if _kind(tables[name], column) == kind]
            for name, names in columns.items()
        }
        found.append(_inclusions(tables, {name: names for name, names in alike.items() if names}))
    return reduce(DataFrame.unionByName, found).where(F.col("contained") >= F.lit(minimum) * F.col("distinct_values"))


def _inclusions(tables: dict[str, DataFrame], columns: dict[str, list[str]]) -> DataFrame:
    parts, holders = [], []
    for table, names in columns.items():
        numbers = {name: len(holders) + i for i, name in enumerate(names)}
        holders += [(table, name) for name in names]
        held = column_values(tables[table], names)
        holder = F.struct(
            F.lit(len(parts)).alias("table"), _lookup(F.col("column"), numbers).alias("column"), F.col("n")
        )
        parts.append(held.select("value", holder.alias("holder")))
    by_value = reduce(DataFrame.unionByName, parts).groupBy("value").agg(F.collect_list("holder").alias("holders"))
    pairs = (
        by_value.select(F.col("value").isNotNull().alias("present"), F.explode("holders").alias("c"), "holders")
        .select("present", "c", F.explode("holders").alias("p"))
        .where((F.col("p.table") != F.col("c.table")) | (F.col("p.column") == F.col("c.column")))
    )
    # A column paired with itself gives its own size; nulls count as rows only.
    counted = pairs.groupBy(F.col("c.column").alias("child"), F.col("p.column").alias("parent")).agg(
        F.count_if("present").alias("contained"), F.sum("c.n").alias("records")
    )
    itself = F.col("child") == F.col("parent")
    of_child, of_parent = W.partitionBy("child"), W.partitionBy("parent")
    sized = counted.select(
        "child",
        "parent",
        "contained",
        F.max(F.when(itself, F.col("contained"))).over(of_child).alias("distinct_values"),
        F.max(F.when(itself, F.col("contained"))).over(of_parent).alias("parent_values"),
        F.max(F.when(itself, F.col("records"))).over(of_parent).alias("parent_records"),
    )

    def name_of(number: str, part: int) -> Column:
        return F.element_at(F.array(*[F.lit(holder[part]) for holder in holders]), F.col(number) + 1)

    return sized.where(~itself & (F.col("parent_values") == F.col("parent_records")) & (F.col("contained") > 0)).select(
        name_of("child", 0).alias("child_table"),
        name_of("child", 1).alias("child_column"),
        name_of("parent", 0).alias("parent_table"),
        name_of("parent", 1).alias("parent_column"),
        "distinct_values",
        "contained",
        (F.col("contained") / F.col("distinct_values")).cast("decimal(5,4)").alias("inclusion"),
    )


def column_scores(
    df: DataFrame,
    table: str,
    classes: Sequence[DataClass],
    vocabularies: dict[str, Sequence[str]],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Quality of each column as percentages; a dimension that does not apply is null.

    completeness: share of non-null values. validity: share of non-null values that match the column's
    data class. consistency: share that belong to the column's vocabulary. uniqueness: distinct share,
    for key columns. quality: mean of those that apply. One pass over the table, plus one grouping per
    key column.
    """
    names = df.columns
    aggregates = [F.count(F.lit(1)).alias("records")]
    for name in names:
        value = F.col(name).cast("string")
        aggregates.append(F.count(F.col(name)).alias(f"present__{name}"))
        data_class = class_for(name, classes)
        matched = F.count_if(value.rlike(data_class.value_pattern)) if data_class else F.lit(None).cast("bigint")
        aggregates.append(matched.alias(f"valid__{name}"))
        known = vocabularies.get(name)
        conforming = F.count_if(value.isin(*known)) if known else F.lit(None).cast("bigint")
        aggregates.append(conforming.alias(f"known__{name}"))
    counted = df.agg(*aggregates)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.col("records"),
                F.col(f"present__{name}").alias("present"),
                F.col(f"valid__{name}").alias("valid"),
                F.col(f"known__{name}").alias("known"),
            )
            for name in names
        ]
    )
    long = counted.select(F.explode(rows).alias("c")).select("c.*")
    scored = long
    if keys:
        distinct = column_values(df, keys).groupBy("column").agg(F.count("value").alias("distinct_values"))
        scored = long.join(distinct, "column", "left")
    else:
        scored = long.withColumn("distinct_values", F.lit(None).cast("bigint"))
    dimensions = ["completeness", "validity", "consistency", "uniqueness"]
    return scored.select(
        F.lit(table).alias("table_name"),
        "column",
        "records",
        _percent("present", "records").alias("completeness"),
        _percent("valid", "present").alias("validity"),
        _percent("known", "present").alias("consistency"),
        _percent("distinct_values", "present").alias("uniqueness"),
    ).withColumn("quality", mean_of(*[F.col(name) for name in dimensions]))


def scorecard(scores: DataFrame) -> DataFrame:
    """Per table: mean of each dimension over the columns it applies to, and overall, the mean of the
    dimensions that apply; `col_avg` is the mean column quality to one decimal."""
    dimensions = ["validity", "completeness", "uniqueness", "consistency"]
    tables = scores.groupBy("table_name").agg(
        F.max("records").alias("records"),
        F.count(F.lit(1)).alias("columns"),
        *[F.avg(name).cast(PERCENT).alias(name) for name in dimensions],
        F.avg("quality").cast("decimal(4,1)").alias("col_avg"),
    )
    return tables.withColumn("overall", mean_of(*[F.col(name) for name in dimensions]))


def mean_of(*parts: Column) -> Column:
    """Mean of the non-null parts, null if there is none."""
    present = F.array_compact(F.array(*parts))
    total = F.aggregate(present, F.lit(0).cast("decimal(20,2)"), lambda acc, x: (acc + x).cast("decimal(20,2)"))
    return F.when(F.size(present) > 0, total / F.size(present)).cast(PERCENT)


def kpis(scorecards: DataFrame, n_classes: int | Column) -> DataFrame:
    """One row over all tables: tables, mean overall score, records (null counts as 0), classes, columns."""
    classes = n_classes if isinstance(n_classes, Column) else F.lit(n_classes)
    return scorecards.agg(
        F.count(F.lit(1)).alias("n_assets"),
        F.avg("overall").cast(PERCENT).alias("avg_dq"),
        F.sum(F.coalesce(F.col("records"), F.lit(0))).alias("total_records"),
        F.sum("columns").alias("n_columns"),
    ).select("n_assets", "avg_dq", "total_records", classes.cast("bigint").alias("n_classes"), "n_columns")


def _percent(part: str, whole: str) -> Column:
    return (F.col(part) * F.lit(100) / F.nullif(F.col(whole), F.lit(0).cast("bigint"))).cast(PERCENT)


def _lookup(key: Column, names: dict[str, str] | dict[str, int]) -> Column:
    pairs = [F.lit(part) for item in names.items() for part in item]
    return F.element_at(F.create_map(*pairs), key)


def _kind(df: DataFrame, name: str) -> str:
    """Columns are comparable within a kind: whole numbers of any width, or one exact type."""
    type_name = df.schema[name].dataType.simpleString()
    return INTEGRAL if type_name in ("tinyint", "smallint", "int", "bigint") else type_name
