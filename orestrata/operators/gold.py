"""Business marts over the order-line fact.

`total_type` is the type of summed money: decimal(14,2) by contract. Totals of very large tables pass
its 12 integer digits, which is an error under ANSI; give money.WIDE there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orestrata.functions import money

COMPLETED = "completed"
STATUSES = ("completed", "returned", "pending", "cancelled")


def daily_sales(fact: DataFrame, total_type: T.DecimalType = money.AMOUNT) -> DataFrame:
    """Completed sales by day and category.

    Lines are first merged per order, so a day and category that hold much of the data are spread
    over their orders before the last, small grouping.
    """
    per_order = (
        fact.where(F.col("status") == COMPLETED)
        .groupBy("order_date", "category", "order_id")
        .agg(F.sum("quantity").alias("units"), F.sum("net_amount").alias("net"))
    )
    return per_order.groupBy("order_date", "category").agg(
        F.count("order_id").alias("order_count"),
        F.sum("units").alias("units_sold"),
        F.sum("net").cast(total_type).alias("net_revenue"),
    )


def category_performance(daily: DataFrame, total_type: T.DecimalType = money.AMOUNT) -> DataFrame:
    """Roll-up of the daily mart. `total_orders` adds up daily counts per category by contract:
    an order that spans two categories counts in both."""
    sums = daily.groupBy("category").agg(
        F.sum("order_count").alias("total_orders"),
        F.sum("units_sold").alias("total_units"),
        F.sum("net_revenue").cast(total_type).alias("total_revenue"),
    )
    return sums.withColumn("avg_revenue_per_unit", money.per_unit(F.col("total_revenue"), F.col("total_units")))


def category_performance_direct(fact: DataFrame, total_type: T.DecimalType = money.AMOUNT) -> DataFrame:
    """The same mart straight from the fact: equal because an order has one date."""
    sums = (
        fact.where(F.col("status") == COMPLETED)
        .groupBy("category")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            F.sum("quantity").alias("total_units"),
            F.sum("net_amount").cast(total_type).alias("total_revenue"),
        )
    )
    return sums.withColumn("avg_revenue_per_unit", money.per_unit(F.col("total_revenue"), F.col("total_units")))


def customer_metrics(
    fact: DataFrame, total_type: T.DecimalType = money.AMOUNT, parts: Sequence[Column] = ()
) -> DataFrame:
    """Per customer: distinct orders by status, completed revenue, last timestamps.

    Lines are merged per order and status first; the four distinct counts are then plain counts and
    no row is multiplied, and a customer with very many orders is already reduced. With `parts` there is a row for each
    customer and part; an order must lie in one part (its month, say), then `customer_roll_up` gives the whole.
    """
    per_order = fact.groupBy("customer_id", "order_id", "status", *parts).agg(
        F.sum("net_amount").alias("net"), F.max("order_ts").alias("order_ts")
    )
    completed = F.col("status") == COMPLETED
    names = per_order.columns[3 : 3 + len(parts)]
    return per_order.groupBy("customer_id", *names).agg(
        *[_orders(status, F.count_if(F.col("status") == status)) for status in STATUSES],
        F.coalesce(F.sum(F.when(completed, F.col("net"))), F.lit(0)).cast(total_type).alias("lifetime_value"),
        F.max(F.when(completed, F.col("order_ts"))).alias("last_completed_order_ts"),
        F.max("order_ts").alias("last_activity_ts"),
    )


def customer_roll_up(parts: DataFrame, total_type: T.DecimalType = money.AMOUNT) -> DataFrame:
    """Metrics per customer from those per customer and part."""
    return parts.groupBy("customer_id").agg(
        *[_orders(status, F.sum(f"{status}_orders")) for status in STATUSES],
        F.sum("lifetime_value").cast(total_type).alias("lifetime_value"),
        F.max("last_completed_order_ts").alias("last_completed_order_ts"),
        F.max("last_activity_ts").alias("last_activity_ts"),
    )


def customer_metrics_expanded(fact: DataFrame, total_type: T.DecimalType = money.AMOUNT) -> DataFrame:
    """The same metrics as four distinct counts; Spark repeats each row per count, so for checks only."""
    completed = F.col("status") == COMPLETED
    return fact.groupBy("customer_id").agg(
        *[
            _orders(status, F.countDistinct(F.when(F.col("status") == status, F.col("order_id"))))
            for status in STATUSES
        ],
        F.coalesce(F.sum(F.when(completed, F.col("net_amount"))), F.lit(0)).cast(total_type).alias("lifetime_value"),
        F.max(F.when(completed, F.col("order_ts"))).alias("last_completed_order_ts"),
        F.max("order_ts").alias("last_activity_ts"),
    )


def customer_360(customers: DataFrame, metrics: DataFrame) -> DataFrame:
    """Every customer with their metrics; without orders the counts are 0 and the timestamps null."""
    counts = [f"{status}_orders" for status in STATUSES]
    joined = customers.join(metrics, "customer_id", "left")
    return joined.select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "country",
        "signup_date",
        *[F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name) for name in counts],
        F.coalesce(F.col("lifetime_value"), F.lit(0).cast(metrics.schema["lifetime_value"].dataType)).alias(
            "lifetime_value"
        ),
        "last_completed_order_ts",
        "last_activity_ts",
    )


def _orders(status: str, count: Column) -> Column:
    return count.alias(f"{status}_orders")
