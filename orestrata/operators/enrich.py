"""The order-line fact: lines joined to orders, products and customers.

Inner joins on purpose: a line whose order, product or customer is missing is dropped, so every mart
sees the same set of lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestrata.contracts import SALES_ENRICHED
from orestrata.functions import money


def sales_enriched(items: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order line.

    Orders meet customers before they meet lines, so the lines, the largest input, are exchanged once
    per large key (product, then order) and not a third time for the customer. Small sides are
    broadcast by Spark from their measured size; no hint is given. The order join comes last: the
    result is partitioned by order, which the distinct order counts of the marts reuse.
    """
    return priced(joined_lines(items, orders, products, customers))


def joined_lines(items: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """The joins of `sales_enriched` without its amounts, which `priced` adds: an exchange in between need not carry them."""
    placed = orders.select("order_id", "customer_id", "order_date", "order_ts", "status", "payment_method").join(
        customers.select("customer_id", F.col("country").alias("customer_country")), "customer_id"
    )
    described = items.select("order_item_id", "order_id", "product_id", "quantity", "discount_pct").join(
        products.select("product_id", "product_name", "category", "unit_price"), "product_id"
    )
    return described.join(placed, "order_id")


def sales_enriched_staged(items: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """The same fact as three binary joins on a shared key name, one stage after the other."""
    return priced(joined_lines_staged(items, orders, products, customers))


def joined_lines_staged(items: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """The joins of `sales_enriched_staged` without its amounts."""
    return (
        items.drop("transformed_at")
        .join(orders.drop("transformed_at"), "order_id")
        .join(products.drop("transformed_at"), "product_id")
        .join(
            customers.select("customer_id", F.col("country").alias("customer_country")),
            "customer_id",
        )
    )


def sales_enriched_colocated(items: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """The same fact from lines and orders that are stored in buckets of the order: they meet first, where they lie."""
    placed = items.select("order_item_id", "order_id", "product_id", "quantity", "discount_pct").join(
        orders.select("order_id", "customer_id", "order_date", "order_ts", "status", "payment_method"), "order_id"
    )
    described = placed.join(products.select("product_id", "product_name", "category", "unit_price"), "product_id")
    return priced(described.join(customers.select("customer_id", F.col("country").alias("customer_country")), "customer_id"))


def priced(joined: DataFrame) -> DataFrame:
    """Joined lines with their amounts: the fact."""
    computed = joined.withColumns(
        {
            "gross_amount": money.gross("quantity", "unit_price"),
            "net_amount": money.net("quantity", "unit_price", "discount_pct"),
            "transformed_at": F.current_timestamp(),
        }
    )
    return computed.select(*SALES_ENRICHED.names)


def dropped_lines(items: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """What the inner joins drop: per missing side the number of lines and units.

    A line counts under the first side it misses, in the order order, product, customer.
    """
    matched_products = products.select("product_id").distinct().withColumn("has_product", F.lit(True))
    # The customer check runs on orders, not on the much larger set of lines.
    matched_orders = orders.select("order_id", "customer_id").join(
        customers.select("customer_id").distinct().withColumn("has_customer", F.lit(True)), "customer_id", "left"
    ).select("order_id", F.lit(True).alias("has_order"), "has_customer")
    checked = items.select("order_id", "product_id", "quantity").join(matched_products, "product_id", "left").join(
        matched_orders, "order_id", "left"
    )
    missing = (
        F.when(F.col("has_order").isNull(), "order")
        .when(F.col("has_product").isNull(), "product")
        .when(F.col("has_customer").isNull(), "customer")
    )
    return (
        checked.withColumn("missing", missing)
        .where(F.col("missing").isNotNull())
        .groupBy("missing")
        .agg(F.count(F.lit(1)).alias("dropped_lines"), F.sum("quantity").alias("dropped_units"))
    )
