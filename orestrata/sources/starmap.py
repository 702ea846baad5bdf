"""The test tables as the four retail entities, in raw form.

customer and nation give customers, part gives products, orders and lineitem give orders and lines.
An email is derived from name and segment; accounts in debt have none, so cleaning drops those
customers and their orders become orphans.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Entities:
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame

    def named(self, layer: str) -> dict[str, DataFrame]:
        return {
            f"{layer}_customers": self.customers,
            f"{layer}_products": self.products,
            f"{layer}_orders": self.orders,
            f"{layer}_order_items": self.order_items,
        }


def raw_entities(scan: Callable[[str], DataFrame]) -> Entities:
    """The four entities over the tables that `scan` opens by name."""
    return Entities(
        customers=raw_customers(scan("customer"), scan("nation")),
        products=raw_products(scan("part")),
        orders=raw_orders(scan("orders")),
        order_items=raw_order_items(scan("lineitem")),
    )


def raw_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    address = F.concat(
        F.lit(" "), F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@"), F.col("c_mktsegment"), F.lit(".Example ")
    )
    days = F.floor(F.abs("c_acctbal") / 10).cast("int")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).select(
        F.col("c_custkey").alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.concat(F.lit(" "), F.split_part("c_name", F.lit("#"), F.lit(2))).alias("last_name"),
        F.when(F.col("c_acctbal") >= 0, address).alias("email"),
        F.date_add(F.lit("1990-01-01").cast("date"), days).cast("string").alias("signup_date"),
        F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")).alias("country"),
    )


def raw_products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
    )


def raw_orders(orders: DataFrame) -> DataFrame:
    status = (
        F.when(F.col("o_orderstatus") == "F", " Completed ")
        .when(F.col("o_orderstatus") == "P", "Returned")
        .when(F.col("o_orderpriority") == "5-LOW", "CANCELLED")
        .otherwise("pending")
    )
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_ts"),
        status.alias("status"),
        F.concat(F.lit(" "), F.col("o_orderpriority")).alias("payment_method"),
    )


def raw_order_items(lineitem: DataFrame) -> DataFrame:
    """Five columns identify a line; joined they are its id."""
    shipped = F.col("l_shipdate").cast("date").cast("string")
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", shipped).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount_pct"),
    )
