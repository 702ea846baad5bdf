"""Ad-hoc questions: row counts, breakdowns, leaderboards, sorted and top-k reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orestrata.functions import money
from orestrata.functions.text import joined


def row_count(df: DataFrame, **labels: str) -> DataFrame:
    """One row: constant labels and the number of rows."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        *[F.lit(value).alias(name) for name, value in labels.items()], "row_count"
    )


def layer_counts(layers: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """Rows of every table: (layer, table_name, row_count)."""
    counts = [
        row_count(df, layer=layer, table_name=name) for layer, tables in layers.items() for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def require_rows(counts: DataFrame, layers: list[str]) -> None:
    """Raise unless every layer holds at least one row."""
    totals = {row["layer"]: row["n"] for row in counts.groupBy("layer").agg(F.sum("row_count").alias("n")).collect()}
    empty = [layer for layer in layers if not totals.get(layer)]
    if empty:
        raise ValueError(f"no rows in layer(s): {', '.join(empty)}")


def breakdown(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, largest first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.desc("row_count"), column)


def checksum(df: DataFrame, column: str, mart: str, as_type: T.DecimalType = money.REPORT) -> DataFrame:
    return df.agg(F.sum(column).cast(as_type).alias("checksum")).select(F.lit(mart).alias("mart"), "checksum")


def checksums(daily: DataFrame, categories: DataFrame, customers: DataFrame, as_type: T.DecimalType = money.REPORT) -> DataFrame:
    """The three marts' revenue totals; equal when no mart lost a line."""
    parts = [
        checksum(daily, "net_revenue", "daily_sales", as_type),
        checksum(categories, "total_revenue", "category_performance", as_type),
        checksum(customers, "lifetime_value", "customer_360", as_type),
    ]
    return reduce(DataFrame.unionByName, parts)


def tagged_union(marts: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """Marts of several builds below each other, each row tagged with its `path`."""
    parts = [df.select(F.lit(path).alias("path"), *columns) for path, df in marts.items()]
    return reduce(DataFrame.unionByName, parts)


def daily_gross(items: DataFrame, orders: DataFrame, products: DataFrame, total_type: T.DecimalType = money.AMOUNT) -> DataFrame:
    """Completed sales before discount, straight from uncleaned entities."""
    done = orders.where(F.col("status") == "completed").select(
        "order_id", F.col("order_ts").cast("date").alias("order_date")
    )
    priced = items.select("order_id", "product_id", "quantity").join(
        products.select("product_id", "category", "unit_price"), "product_id"
    )
    lines = priced.select("order_id", "category", "quantity", (F.col("quantity") * F.col("unit_price")).alias("gross"))
    return (
        lines.join(done, "order_id")
        # Partitioned by order already: this merge needs no exchange. A repeated order id counts once.
        .groupBy("order_date", "category", "order_id")
        .agg(F.sum("quantity").alias("units"), F.sum("gross").alias("gross"))
        .groupBy("order_date", "category")
        .agg(
            F.count("order_id").alias("order_count"),
            F.sum("units").alias("units_sold"),
            F.sum("gross").cast(total_type).alias("gross_revenue"),
        )
    )


def customer_leaderboard(
    customers: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    top: int = 10,
    total_type: T.DecimalType = money.AMOUNT,
) -> DataFrame:
    """Customers (by name and country) with the highest revenue before discount, all statuses."""
    priced = items.select("order_id", "product_id", "quantity").join(
        products.select("product_id", "unit_price"), "product_id"
    )
    per_order = priced.groupBy("order_id").agg(F.sum(F.col("quantity") * F.col("unit_price")).alias("gross"))
    buyers = orders.select("order_id", "customer_id").join(
        customers.select("customer_id", "first_name", "last_name", "country"), "customer_id"
    )
    return top_k(
        per_order.join(buyers, "order_id")
        .groupBy("first_name", "last_name", "country", "order_id")
        .agg(F.sum("gross").alias("gross"))
        .groupBy("first_name", "last_name", "country")
        .agg(F.count("order_id").alias("total_orders"), F.sum("gross").cast(total_type).alias("total_revenue"))
        .select(joined(" ", "first_name", "last_name").alias("customer_name"), "country", "total_orders", "total_revenue"),
        top,
        F.desc("total_revenue"),
        F.asc("customer_name"),
    )


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows in `order`; each task keeps only k rows."""
    return df.orderBy(*order).limit(k)


def daily_report(daily: DataFrame) -> DataFrame:
    return daily.orderBy("order_date", "category")


def customer_report(customers: DataFrame) -> DataFrame:
    return customers.orderBy(F.desc("lifetime_value"), "customer_id")


def between_dates(df: DataFrame, first: str, last: str, day: str = "order_date", month: str | None = "order_month") -> DataFrame:
    """Rows of a date range; names the month partition as well, so other months are not read."""
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    kept = df.where(F.col(day).between(low, high))
    if month and month in df.columns:
        kept = kept.where(F.col(month).between(F.trunc(low, "month"), F.trunc(high, "month")))
    return kept
