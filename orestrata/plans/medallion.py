"""The whole medallion: raw entities to tested marts, layer by layer."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orestrata.functions import money
from orestrata.operators import bronze, enrich, gold, silver
from orestrata.operators.quality import AcceptedValues, NotNull, Relationship, Test, Unique
from orestrata.operators.spine import FIRST_DAY, LAST_DAY, spine_of, time_spine
from orestrata.sinks.tables import replace_monthly_table, replace_table
from orestrata.sources.starmap import Entities


@dataclass(frozen=True)
class Profile:
    """Types that depend on the size of the data: keys, line keys and money totals."""

    key_type: str = "int"
    line_key_type: str = "int"
    total_type: T.DecimalType = money.AMOUNT


RETAIL = Profile()
# Ids beyond 32 bits, lines with a composite text id, totals beyond 12 digits.
LARGE = Profile("bigint", "string", money.WIDE)


def to_bronze(raw: Entities, ingested_by: str = "batch load", batch_id: str = bronze.DEFAULT_BATCH) -> Entities:
    return Entities(
        customers=bronze.annotate(raw.customers, ingested_by, "raw_customers.csv", batch_id),
        products=bronze.annotate(raw.products, ingested_by, "raw_products.csv", batch_id),
        orders=bronze.annotate(raw.orders, ingested_by, "raw_orders.csv", batch_id),
        order_items=bronze.annotate(raw.order_items, ingested_by, "raw_order_items.csv", batch_id),
    )


def to_silver(landed: Entities, profile: Profile = RETAIL) -> Entities:
    return Entities(
        customers=silver.clean_customers(landed.customers, profile.key_type),
        products=silver.clean_products(landed.products, profile.key_type),
        orders=silver.clean_orders(landed.orders, profile.key_type),
        order_items=silver.clean_order_items(landed.order_items, profile.key_type, profile.line_key_type),
    )


def to_fact(clean: Entities) -> DataFrame:
    return enrich.sales_enriched(clean.order_items, clean.orders, clean.products, clean.customers)


def to_marts(fact: DataFrame, customers: DataFrame, profile: Profile = RETAIL) -> dict[str, DataFrame]:
    daily = gold.daily_sales(fact, profile.total_type)
    return {
        "daily_sales": daily,
        "category_performance": gold.category_performance(daily, profile.total_type),
        "customer_360": gold.customer_360(customers, gold.customer_metrics(fact, profile.total_type)),
    }


def side_by_side(steps: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Run independent writes at the same time, so that small ones do not wait for large ones."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = {name: pool.submit(step) for name, step in steps.items()}
        return {name: run.result() for name, run in running.items()}


def build(
    raw: Entities, root: str, profile: Profile = RETAIL, calendar: tuple[date, date] | None = (FIRST_DAY, LAST_DAY)
) -> dict[str, DataFrame]:
    """Store every layer below `root` and return the stored tables by name.

    Each layer reads the stored one before it, so a lost executor costs the step it was in, and the
    fact is joined once for all marts. Orders, fact and daily mart are partitioned by month. The two
    thin marts stay views of stored tables. The calendar has the days from the first to the last of
    `calendar`; with None, those of the orders.
    """
    tables = raw.named("raw")
    landed = side_by_side(
        {
            name: partial(replace_table, df, f"{root}/bronze/{name}")
            for name, df in to_bronze(raw).named("bronze").items()
        }
    )
    tables |= landed
    clean = to_silver(Entities(*landed.values()), profile).named("silver")
    stored = side_by_side(
        {
            name: partial(replace_monthly_table if name == "silver_orders" else replace_table, df, f"{root}/silver/{name}")
            for name, df in clean.items()
        }
    )
    tables |= stored
    entities = Entities(*stored.values())
    lines = enrich.joined_lines(entities.order_items, entities.orders, entities.products, entities.customers)
    fact = replace_monthly_table(lines, f"{root}/silver/silver_sales_enriched", derive=enrich.priced)
    tables["silver_sales_enriched"] = fact
    spine = time_spine(fact.sparkSession, *calendar) if calendar else spine_of(entities.orders, "order_date")
    tables["time_spine_daily"] = replace_table(spine, f"{root}/silver/time_spine_daily")
    daily = replace_monthly_table(gold.daily_sales(fact, profile.total_type), f"{root}/gold/gold_daily_sales")
    tables["gold_daily_sales"] = daily
    tables["gold_category_performance"] = gold.category_performance(daily, profile.total_type)
    tables["gold_customer_360"] = gold.customer_360(
        entities.customers, gold.customer_metrics(fact, profile.total_type)
    )
    return tables


def layers(tables: dict[str, DataFrame]) -> dict[str, dict[str, DataFrame]]:
    """The tables of `build` by layer."""
    found: dict[str, dict[str, DataFrame]] = {}
    for name, df in tables.items():
        layer = name.split("_", 1)[0]
        found.setdefault("silver" if layer == "time" else layer, {})[name] = df
    return found


# The declared tests of the medallion.
TESTS: tuple[Test, ...] = (
    NotNull("raw_customers", "customer_id"),
    Unique("raw_customers", "customer_id"),
    NotNull("raw_customers", "email"),
    NotNull("raw_products", "product_id"),
    Unique("raw_products", "product_id"),
    NotNull("raw_orders", "order_id"),
    Unique("raw_orders", "order_id"),
    NotNull("raw_order_items", "order_item_id"),
    Unique("raw_order_items", "order_item_id"),
    NotNull("silver_customers", "customer_id"),
    Unique("silver_customers", "customer_id"),
    NotNull("silver_products", "product_id"),
    Unique("silver_products", "product_id"),
    NotNull("silver_orders", "order_id"),
    Unique("silver_orders", "order_id"),
    Relationship("silver_orders", "customer_id", "silver_customers", "customer_id"),
    AcceptedValues("silver_orders", "status", gold.STATUSES),
    NotNull("silver_order_items", "order_item_id"),
    Unique("silver_order_items", "order_item_id"),
    Relationship("silver_order_items", "order_id", "silver_orders", "order_id"),
    Relationship("silver_order_items", "product_id", "silver_products", "product_id"),
    NotNull("silver_sales_enriched", "order_item_id"),
    Unique("silver_sales_enriched", "order_item_id"),
    Relationship("silver_sales_enriched", "order_id", "silver_orders", "order_id"),
    Relationship("silver_sales_enriched", "customer_id", "silver_customers", "customer_id"),
    Relationship("silver_sales_enriched", "product_id", "silver_products", "product_id"),
    NotNull("time_spine_daily", "date_day"),
    Unique("time_spine_daily", "date_day"),
    NotNull("gold_daily_sales", "order_date"),
    NotNull("gold_daily_sales", "category"),
    NotNull("gold_category_performance", "category"),
    Unique("gold_category_performance", "category"),
    NotNull("gold_customer_360", "customer_id"),
    Unique("gold_customer_360", "customer_id"),
)
