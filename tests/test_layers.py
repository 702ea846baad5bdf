"""Cleaning rules, joins and marts on hand-made dirty rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from shop import entities, rows

from orestrata import contracts
from orestrata.functions import money, times
from orestrata.functions.types import catalog_type
from orestrata.operators import bronze, enrich, gold, reports, silver, spine
from orestrata.plans import medallion


@pytest.fixture(scope="module")
def raw(spark):
    return entities(spark)


@pytest.fixture(scope="module")
def clean(raw):
    return medallion.to_silver(raw)


@pytest.fixture(scope="module")
def fact(clean):
    return medallion.to_fact(clean)


def test_bronze_adds_audit_columns(raw):
    landed = bronze.annotate(raw.orders, "loader", "orders.csv", times.batch_label("raw", F.lit("2026-05-06 07:08:09").cast("timestamp")))
    row = landed.first()
    assert landed.columns == raw.orders.columns + contracts.AUDIT.names
    assert (row["_ingested_by"], row["_source_file"], row["_ingest_batch_id"]) == ("loader", "orders.csv", "raw_20260506_0708")
    assert row["_ingested_at"] is not None


def test_customers(raw):
    kept = silver.clean_customers(raw.customers)
    assert [r[0] for r in rows(kept, "customer_id")] == [1, 2, 4, 5]
    first = kept.where("customer_id = 1").first()
    assert first[1:6] == ("Amina", "Khan", "amina@x.com", date(2025, 10, 29), "DE")
    strict = silver.clean_customers(raw.customers, drop_blank_email=True)
    assert [r[0] for r in rows(strict, "customer_id")] == [1, 2, 5]


def test_tabs_are_kept(spark):
    df = spark.createDataFrame([("1", "\tA ", "b", "c@d.ee", "2026-01-01", "x")], contracts.RAW_CUSTOMERS.names)
    assert silver.clean_customers(df).first()["first_name"] == "\tA"


def test_products_and_orders(raw):
    products = silver.clean_products(raw.products)
    assert rows(products, "product_id", "product_name", "category", "unit_price") == [
        (10, "Pen", "Office", Decimal("0.50")),
        (11, "Lamp", "Home", Decimal("100.01")),
        (12, "Tea", "Grocery", Decimal("3.99")),
    ]
    orders = silver.clean_orders(raw.orders)
    assert orders.count() == 7
    assert rows(orders.where("order_id = 100"), "order_ts", "order_date", "status", "payment_method") == [
        (datetime(2026, 1, 2, 10), date(2026, 1, 2), "completed", "card")
    ]


def test_only_positive_quantities(raw):
    kept = [r[0] for r in rows(silver.clean_order_items(raw.order_items), "order_item_id")]
    assert set(range(1000, 1014)) - set(kept) == {1005, 1006, 1007}


def test_schemas_match_contracts(clean, fact):
    for name, df in {**clean.named("silver"), "silver_sales_enriched": fact}.items():
        declared = contracts.CONTRACTS[name].schema
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in declared], name
    for mart, df in medallion.to_marts(fact, clean.customers).items():
        declared = contracts.CONTRACTS[f"gold_{mart}"].schema
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in declared], mart


def test_fact_drops_orphans_and_rounds_lines(fact):
    assert rows(fact, "order_item_id", "gross_amount", "net_amount") == [
        (1000, Decimal("0.50"), Decimal("0.43")),
        (1001, Decimal("200.02"), Decimal("200.02")),
        (1002, Decimal("3.99"), Decimal("3.59")),
        (1003, Decimal("19.95"), Decimal("19.95")),
        (1004, Decimal("100.01"), Decimal("95.01")),
        (1012, Decimal("7.98"), Decimal("7.98")),
        (1013, Decimal("3.99"), Decimal("3.99")),
    ]


def test_staged_joins_build_the_same_fact(clean, fact):
    staged = enrich.sales_enriched_staged(clean.order_items, clean.orders, clean.products, clean.customers)
    assert staged.columns == fact.columns
    assert rows(staged.drop("transformed_at")) == rows(fact.drop("transformed_at"))


def test_dropped_lines(clean):
    dropped = enrich.dropped_lines(clean.order_items, clean.orders, clean.products, clean.customers)
    assert rows(dropped) == [("customer", 2, 2), ("order", 1, 1), ("product", 1, 1)]


def test_daily_and_category(fact):
    daily = gold.daily_sales(fact)
    assert rows(daily) == [
        (date(2026, 1, 2), "Grocery", 1, 1, Decimal("3.59")),
        (date(2026, 1, 2), "Home", 1, 2, Decimal("200.02")),
        (date(2026, 1, 2), "Office", 1, 1, Decimal("0.43")),
        (date(2026, 2, 1), "Home", 1, 1, Decimal("95.01")),
    ]
    category = gold.category_performance(daily)
    assert rows(category) == [
        ("Grocery", 1, 1, Decimal("3.59"), Decimal("3.59")),
        ("Home", 2, 3, Decimal("295.03"), Decimal("98.34")),
        ("Office", 1, 1, Decimal("0.43"), Decimal("0.43")),
    ]
    # One order in three categories counts three times here, by contract.
    assert sum(r[1] for r in rows(category)) == 4
    assert rows(gold.category_performance_direct(fact)) == rows(category)


def test_no_units_gives_null_average(spark):
    daily = spark.createDataFrame(
        [(date(2026, 1, 1), "X", 1, 0, Decimal("5.00"))],
        "order_date date, category string, order_count bigint, units_sold bigint, net_revenue decimal(14,2)",
    )
    assert gold.category_performance(daily).first()["avg_revenue_per_unit"] is None


def test_totals_beyond_the_contract_type(spark):
    big = Decimal("999999999999.99")
    daily = spark.createDataFrame(
        [(date(2026, 1, d), "X", 1, 1, big) for d in (1, 2)],
        "order_date date, category string, order_count bigint, units_sold bigint, net_revenue decimal(14,2)",
    )
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        gold.category_performance(daily).collect()
    assert gold.category_performance(daily, money.WIDE).first()["total_revenue"] == 2 * big


def test_customer_360(clean, fact):
    wanted = [
        (1, 1, 1, 0, 0, Decimal("204.04"), datetime(2026, 1, 2, 10), datetime(2026, 1, 3, 11)),
        (2, 1, 0, 1, 1, Decimal("95.01"), datetime(2026, 2, 1), datetime(2026, 2, 5)),
        (4, 0, 0, 0, 0, Decimal("0.00"), None, None),
        (5, 0, 0, 0, 0, Decimal("0.00"), None, None),
    ]
    columns = ["customer_id", *[f"{s}_orders" for s in gold.STATUSES], "lifetime_value", "last_completed_order_ts", "last_activity_ts"]
    assert rows(gold.customer_360(clean.customers, gold.customer_metrics(fact)), *columns) == wanted
    assert rows(gold.customer_360(clean.customers, gold.customer_metrics_expanded(fact)), *columns) == wanted


def test_spine(spark, fact):
    assert spine.time_spine(spark).agg(F.count("*"), F.min("date_day"), F.max("date_day")).first()[:] == (
        730,
        date(2025, 1, 1),
        date(2026, 12, 31),
    )
    per_day = gold.daily_sales(fact).groupBy("order_date").agg(F.sum("net_revenue").alias("net_revenue"))
    filled = spine.on_spine(spine.spine_of(per_day, "order_date"), per_day, "order_date", ["net_revenue"])
    assert filled.count() == 31
    assert filled.where("net_revenue = 0").count() == 29


def test_month_functions(spark):
    df = spark.createDataFrame([(date(2026, 1, 31),), (date(1969, 12, 1),)], "d date")
    ordinal = times.month_ordinal("d")
    assert rows(df.select(ordinal, times.ordinal_label(ordinal))) == [(-1, "1969-12"), (672, "2026-01")]
    with pytest.raises(ValueError):
        times.at_grain("d", "hour")


def test_catalog_types(spark):
    names = ["decimal(14, 2)", "VARCHAR", "timestamp(3)", "array<int>", "timestamp with time zone"]
    df = spark.createDataFrame([(n,) for n in names], "t string").select(catalog_type(F.col("t")).alias("c")).select("c.*")
    assert sorted(tuple(r) for r in df.select("display", "data_type").collect()) == sorted(
        [("decimal(14, 2)", "DECIMAL"), ("VARCHAR", "VARCHAR"), ("timestamp(3)", "TIMESTAMP"), ("array<int>", "UNKNOWN"),
         ("timestamp with time zone", "TIMESTAMPZ")]
    )
    assert df.where("data_type = 'DECIMAL'").select("precision", "scale").first()[:] == (14, 2)


def test_reports(raw, clean, fact):
    assert [tuple(r) for r in reports.breakdown(clean.orders, "status").collect()][0] == ("completed", 4)
    raw_orders = raw.orders.withColumn("status", F.lower(F.trim("status")))
    board = reports.customer_leaderboard(clean.customers, raw_orders, clean.order_items, clean.products, top=1)
    assert board.first()[:] == ("Amina Khan", "DE", 2, Decimal("224.46"))
    counts = reports.layer_counts({"silver": clean.named("silver"), "gold": {"daily": gold.daily_sales(fact)}})
    reports.require_rows(counts, ["silver", "gold"])
    with pytest.raises(ValueError, match="bronze"):
        reports.require_rows(counts, ["silver", "bronze"])
    gross = reports.daily_gross(raw.order_items.withColumn("quantity", F.col("quantity").cast("int")), raw_orders, clean.products)
    assert gross.where("category = 'Home'").agg(F.sum("gross_revenue")).first()[0] == Decimal("300.03")


def test_repeated_order_counts_once(raw, clean):
    """Uncleaned orders may hold an id twice: its lines double, the order does not."""
    orders = raw.orders.withColumn("status", F.lower(F.trim("status")))
    doubled = orders.unionByName(orders.where("order_id = '100'"))
    gross = reports.daily_gross(clean.order_items, doubled, clean.products)
    home = gross.where("category = 'Home' and order_date = '2026-01-02'").first()
    assert (home["order_count"], home["units_sold"]) == (1, 4)
