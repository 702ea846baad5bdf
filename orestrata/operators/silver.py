"""Cleaning rules, the same for batch frames and streams.

Keys are cast to `key_type`: int for the retail entities, bigint where ids outgrow it. Columns named in
`carry` are kept as they are, behind the declared ones; a change log's sequence number is such a column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.functions import text
from orestrata.functions.money import DISCOUNT, PRICE


def _stamp() -> Column:
    return F.current_timestamp().alias("transformed_at")


def clean_customers(
    raw: DataFrame, key_type: str = "int", drop_blank_email: bool = False, carry: Sequence[str] = ()
) -> DataFrame:
    """Customers with an email; the streaming contract also drops blank ones."""
    kept = raw.where(F.col("email").isNotNull())
    if drop_blank_email:
        kept = kept.where(text.trimmed("email") != "")
    return kept.select(
        F.col("customer_id").cast(key_type).alias("customer_id"),
        text.trimmed("first_name").alias("first_name"),
        text.trimmed("last_name").alias("last_name"),
        text.lowered("email").alias("email"),
        F.col("signup_date").cast("date").alias("signup_date"),
        text.uppered("country").alias("country"),
        _stamp(),
        *carry,
    )


def clean_products(raw: DataFrame, key_type: str = "int", carry: Sequence[str] = ()) -> DataFrame:
    return raw.where(F.col("product_id").isNotNull()).select(
        F.col("product_id").cast(key_type).alias("product_id"),
        text.trimmed("product_name").alias("product_name"),
        text.trimmed("category").alias("category"),
        F.col("unit_price").cast(PRICE).alias("unit_price"),
        _stamp(),
        *carry,
    )


def clean_orders(raw: DataFrame, key_type: str = "int", carry: Sequence[str] = ()) -> DataFrame:
    placed = F.col("order_ts").cast("timestamp_ntz")
    return raw.where(F.col("order_id").isNotNull()).select(
        F.col("order_id").cast(key_type).alias("order_id"),
        F.col("customer_id").cast(key_type).alias("customer_id"),
        placed.alias("order_ts"),
        placed.cast("date").alias("order_date"),
        text.lowered("status").alias("status"),
        text.lowered("payment_method").alias("payment_method"),
        _stamp(),
        *carry,
    )


def clean_order_items(
    raw: DataFrame, key_type: str = "int", line_key_type: str | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """Lines with a positive quantity; a null quantity is dropped too."""
    return raw.where(F.col("quantity") > 0).select(
        F.col("order_item_id").cast(line_key_type or key_type).alias("order_item_id"),
        F.col("order_id").cast(key_type).alias("order_id"),
        F.col("product_id").cast(key_type).alias("product_id"),
        F.col("quantity").cast("int").alias("quantity"),
        F.col("discount_pct").cast(DISCOUNT).alias("discount_pct"),
        _stamp(),
        *carry,
    )
