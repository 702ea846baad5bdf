"""Schemas, keys, references and column tags of every layer: one source for batch, stream and tests."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orestrata.functions.money import AMOUNT, DISCOUNT, PRICE

PII = "PII"
FINANCIAL = "FinancialMetric"

_INT = T.IntegerType()
_LONG = T.LongType()
_DOUBLE = T.DoubleType()
_TEXT = T.StringType()
_DATE = T.DateType()
_PLAIN_TS = T.TimestampNTZType()
_ZONED_TS = T.TimestampType()


@dataclass(frozen=True)
class Contract:
    name: str
    layer: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    # column -> (table, column) it must exist in
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    feeds: tuple[str, ...] = ()


def _field(name: str, kind: T.DataType, *tags: str, required: bool = False) -> T.StructField:
    return T.StructField(name, kind, not required, {"tags": list(tags)} if tags else None)


def _schema(*fields: T.StructField) -> T.StructType:
    return T.StructType(list(fields))


# Audit columns that the landing layer adds.
AUDIT = _schema(
    _field("_ingested_at", _ZONED_TS),
    _field("_ingested_by", _TEXT),
    _field("_source_file", _TEXT),
    _field("_ingest_batch_id", _TEXT),
)

# The text edge: all fields required, money still floating, dates still ISO text.
RAW_CUSTOMERS = _schema(
    _field("customer_id", _INT, required=True),
    _field("first_name", _TEXT, required=True),
    _field("last_name", _TEXT, required=True),
    _field("email", _TEXT, PII, required=True),
    _field("signup_date", _TEXT, required=True),
    _field("country", _TEXT, required=True),
)
RAW_PRODUCTS = _schema(
    _field("product_id", _INT, required=True),
    _field("product_name", _TEXT, required=True),
    _field("category", _TEXT, required=True),
    _field("unit_price", _DOUBLE, FINANCIAL, required=True),
)
RAW_ORDERS = _schema(
    _field("order_id", _INT, required=True),
    _field("customer_id", _INT, required=True),
    _field("order_ts", _TEXT, required=True),
    _field("status", _TEXT, required=True),
    _field("payment_method", _TEXT, required=True),
)
RAW_ORDER_ITEMS = _schema(
    _field("order_item_id", _INT, required=True),
    _field("order_id", _INT, required=True),
    _field("product_id", _INT, required=True),
    _field("quantity", _INT, required=True),
    _field("discount_pct", _DOUBLE, FINANCIAL, required=True),
)

SILVER_CUSTOMERS = _schema(
    _field("customer_id", _INT),
    _field("first_name", _TEXT),
    _field("last_name", _TEXT),
    _field("email", _TEXT, PII),
    _field("signup_date", _DATE),
    _field("country", _TEXT),
    _field("transformed_at", _ZONED_TS),
)
SILVER_PRODUCTS = _schema(
    _field("product_id", _INT),
    _field("product_name", _TEXT),
    _field("category", _TEXT),
    _field("unit_price", PRICE, FINANCIAL),
    _field("transformed_at", _ZONED_TS),
)
SILVER_ORDERS = _schema(
    _field("order_id", _INT),
    _field("customer_id", _INT),
    _field("order_ts", _PLAIN_TS),
    _field("order_date", _DATE),
    _field("status", _TEXT),
    _field("payment_method", _TEXT),
    _field("transformed_at", _ZONED_TS),
)
SILVER_ORDER_ITEMS = _schema(
    _field("order_item_id", _INT),
    _field("order_id", _INT),
    _field("product_id", _INT),
    _field("quantity", _INT),
    _field("discount_pct", DISCOUNT, FINANCIAL),
    _field("transformed_at", _ZONED_TS),
)
SALES_ENRICHED = _schema(
    _field("order_item_id", _INT),
    _field("order_id", _INT),
    _field("order_date", _DATE),
    _field("order_ts", _PLAIN_TS),
    _field("status", _TEXT),
    _field("payment_method", _TEXT),
    _field("customer_id", _INT),
    _field("customer_country", _TEXT),
    _field("product_id", _INT),
    _field("product_name", _TEXT),
    _field("category", _TEXT),
    _field("quantity", _INT),
    _field("unit_price", PRICE, FINANCIAL),
    _field("discount_pct", DISCOUNT, FINANCIAL),
    _field("gross_amount", AMOUNT, FINANCIAL),
    _field("net_amount", AMOUNT, FINANCIAL),
    _field("transformed_at", _ZONED_TS),
)
TIME_SPINE = _schema(_field("date_day", _DATE))

DAILY_SALES = _schema(
    _field("order_date", _DATE),
    _field("category", _TEXT),
    _field("order_count", _LONG),
    _field("units_sold", _LONG),
    _field("net_revenue", AMOUNT, FINANCIAL),
)
CATEGORY_PERFORMANCE = _schema(
    _field("category", _TEXT),
    _field("total_orders", _LONG),
    _field("total_units", _LONG),
    _field("total_revenue", AMOUNT, FINANCIAL),
    _field("avg_revenue_per_unit", AMOUNT, FINANCIAL),
)
CUSTOMER_360 = _schema(
    _field("customer_id", _INT),
    _field("first_name", _TEXT),
    _field("last_name", _TEXT),
    _field("email", _TEXT, PII),
    _field("country", _TEXT),
    _field("signup_date", _DATE),
    _field("completed_orders", _LONG),
    _field("returned_orders", _LONG),
    _field("pending_orders", _LONG),
    _field("cancelled_orders", _LONG),
    _field("lifetime_value", AMOUNT, FINANCIAL),
    _field("last_completed_order_ts", _PLAIN_TS),
    _field("last_activity_ts", _PLAIN_TS),
)


def _landed(raw: T.StructType) -> T.StructType:
    return T.StructType(list(raw.fields) + list(AUDIT.fields))


CONTRACTS: dict[str, Contract] = {
    c.name: c
    for c in [
        Contract("raw_customers", "raw", RAW_CUSTOMERS, ("customer_id",)),
        Contract("raw_products", "raw", RAW_PRODUCTS, ("product_id",)),
        Contract("raw_orders", "raw", RAW_ORDERS, ("order_id",),
                 {"customer_id": ("raw_customers", "customer_id")}),
        Contract("raw_order_items", "raw", RAW_ORDER_ITEMS, ("order_item_id",),
                 {"order_id": ("raw_orders", "order_id"), "product_id": ("raw_products", "product_id")}),
        Contract("bronze_customers", "bronze", _landed(RAW_CUSTOMERS), ("customer_id",),
                 feeds=("raw_customers",)),
        Contract("bronze_products", "bronze", _landed(RAW_PRODUCTS), ("product_id",),
                 feeds=("raw_products",)),
        Contract("bronze_orders", "bronze", _landed(RAW_ORDERS), ("order_id",),
                 {"customer_id": ("bronze_customers", "customer_id")}, ("raw_orders",)),
        Contract("bronze_order_items", "bronze", _landed(RAW_ORDER_ITEMS), ("order_item_id",),
                 feeds=("raw_order_items",)),
        Contract("silver_customers", "silver", SILVER_CUSTOMERS, ("customer_id",),
                 feeds=("bronze_customers",)),
        Contract("silver_products", "silver", SILVER_PRODUCTS, ("product_id",),
                 feeds=("bronze_products",)),
        Contract("silver_orders", "silver", SILVER_ORDERS, ("order_id",),
                 {"customer_id": ("silver_customers", "customer_id")}, ("bronze_orders",)),
        Contract("silver_order_items", "silver", SILVER_ORDER_ITEMS, ("order_item_id",),
                 {"order_id": ("silver_orders", "order_id"),
                  "product_id": ("silver_products", "product_id")},
                 ("bronze_order_items",)),
        Contract("silver_sales_enriched", "silver", SALES_ENRICHED, ("order_item_id",),
                 {"order_id": ("silver_orders", "order_id"),
                  "customer_id": ("silver_customers", "customer_id"),
                  "product_id": ("silver_products", "product_id")},
                 ("silver_order_items", "silver_orders", "silver_products", "silver_customers")),
        Contract("time_spine_daily", "silver", TIME_SPINE, ("date_day",)),
        Contract("gold_daily_sales", "gold", DAILY_SALES, ("order_date", "category"),
                 feeds=("silver_sales_enriched",)),
        Contract("gold_category_performance", "gold", CATEGORY_PERFORMANCE, ("category",),
                 feeds=("gold_daily_sales",)),
        Contract("gold_customer_360", "gold", CUSTOMER_360, ("customer_id",),
                 {"customer_id": ("silver_customers", "customer_id")},
                 ("silver_sales_enriched", "silver_customers")),
    ]
}

# Marts two builds must agree on, with the column list that is compared.
MARTS: dict[str, list[str]] = {
    "daily_sales": DAILY_SALES.names,
    "category_performance": CATEGORY_PERFORMANCE.names,
    "customer_360": CUSTOMER_360.names,
}


def with_tags(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Attach a contract's column tags to the columns of the same name."""
    for declared in schema.fields:
        if declared.metadata and declared.name in df.columns:
            df = df.withMetadata(declared.name, declared.metadata)
    return df


def tagged_columns(df: DataFrame, tag: str) -> list[str]:
    """Columns that carry `tag`."""
    return [f.name for f in df.schema.fields if tag in (f.metadata or {}).get("tags", [])]
