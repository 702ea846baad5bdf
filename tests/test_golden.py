"""Published results of the retail demo data.

The four CSV files are not part of this repository; name their folder in RETAIL_CSV_DIR to run these.
"""

import os
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from shop import rows

from orestrata import contracts
from orestrata.operators import enrich, gold, governance, profile, quality, reconcile, reports, semantic
from orestrata.plans import medallion
from orestrata.sinks import versions
from orestrata.sources import coerce, files
from orestrata.sources.starmap import Entities

FOLDER = os.environ.get("RETAIL_CSV_DIR")

pytestmark = pytest.mark.skipif(not FOLDER, reason="RETAIL_CSV_DIR is not set")


@pytest.fixture(scope="module")
def raw(spark):
    def scan(name):
        schema = contracts.CONTRACTS[f"raw_{name}"].schema
        text = files.csv_text(spark, f"{FOLDER}/raw_{name}.csv", schema.names)
        coerced = coerce.coerce(text, schema)
        assert coerce.outcome(coerced).first()["skipped"] == 0
        return coerce.accepted(coerced)

    return Entities(scan("customers"), scan("products"), scan("orders"), scan("order_items"))


@pytest.fixture(scope="module")
def built(raw, tmp_path_factory):
    return medallion.build(raw, str(tmp_path_factory.mktemp("medallion")))


def test_row_counts(built):
    counts = {r["table_name"]: r["row_count"] for r in quality.table_counts(built).collect()}
    for layer in ("raw", "bronze", "silver"):
        assert [counts[f"{layer}_{e}"] for e in ("customers", "products", "orders", "order_items")] == [50, 20, 500, 1134]
    assert counts["silver_sales_enriched"] == 1134
    assert counts["time_spine_daily"] == 730
    assert [counts[f"gold_{m}"] for m in contracts.MARTS] == [494, 5, 50]


def test_checksums(built):
    sums = reports.checksums(built["gold_daily_sales"], built["gold_category_performance"], built["gold_customer_360"])
    assert {r["checksum"] for r in sums.collect()} == {Decimal("87509.85")}
    total = built["gold_category_performance"].agg(F.sum("avg_revenue_per_unit")).first()[0]
    assert total == Decimal("236.57")
    fact = built["silver_sales_enriched"].agg(F.sum("gross_amount"), F.sum("net_amount")).first()
    assert fact[:] == (Decimal("122513.05"), Decimal("113985.47"))
    daily = built["gold_daily_sales"].agg(F.sum("order_count"), F.sum("units_sold"), F.countDistinct("order_date")).first()
    assert daily[:] == (745, 1744, 147)


def test_categories(built):
    assert rows(built["gold_category_performance"]) == [
        ("Electronics", 186, 447, Decimal("38185.63"), Decimal("85.43")),
        ("Grocery", 113, 276, Decimal("5593.24"), Decimal("20.27")),
        ("Home", 161, 383, Decimal("12473.53"), Decimal("32.57")),
        ("Office", 151, 333, Decimal("15161.60"), Decimal("45.53")),
        ("Outdoor", 134, 305, Decimal("16095.85"), Decimal("52.77")),
    ]
    assert rows(gold.category_performance_direct(built["silver_sales_enriched"])) == rows(built["gold_category_performance"])


def test_statuses_and_months(built):
    found = [tuple(r) for r in reports.breakdown(built["silver_orders"], "status").collect()]
    assert found == [("completed", 380), ("returned", 70), ("cancelled", 33), ("pending", 17)]
    stats = versions.partition_stats(built["silver_orders"])
    assert rows(stats, "month_ordinal", "month", "row_count") == [
        (672, "2026-01", 85),
        (673, "2026-02", 84),
        (674, "2026-03", 109),
        (675, "2026-04", 86),
        (676, "2026-05", 97),
        (677, "2026-06", 39),
    ]


def test_reports(built):
    best = reports.customer_report(built["gold_customer_360"]).limit(5).select("customer_id", "lifetime_value").collect()
    assert [tuple(r) for r in best] == [
        (1042, Decimal("3485.96")),
        (1004, Decimal("3443.59")),
        (1048, Decimal("3227.60")),
        (1039, Decimal("3120.76")),
        (1033, Decimal("3099.22")),
    ]
    first = reports.daily_report(built["gold_daily_sales"]).first()
    assert first[:5] == (date(2026, 1, 3), "Electronics", 1, 4, Decimal("392.00"))


def test_declared_tests_pass(built):
    results = quality.run_tests(built, medallion.TESTS)
    assert results.count() == 34
    assert results.where("status <> 'PASS'").isEmpty()


def test_second_build_agrees(built):
    fact = enrich.sales_enriched_staged(
        *[built[f"silver_{e}"].drop("order_month") for e in ("order_items", "orders", "products", "customers")]
    )
    assert rows(fact.drop("transformed_at")) == rows(built["silver_sales_enriched"].drop("transformed_at", "order_month"))
    stored = {m: built[f"gold_{m}"] for m in contracts.MARTS}
    result = reconcile.reconcile({"stored": stored, "staged": medallion.to_marts(fact, built["silver_customers"])})
    assert {r["status"] for r in result.collect()} == {"PASS"}


def test_metrics(built):
    found = semantic.metric_query(
        semantic.DAILY_SALES, built["gold_daily_sales"], ["total_net_revenue", "total_orders"], ["category"]
    )
    assert dict((r[0], r[2]) for r in rows(found))["Electronics"] == 186
    lines = semantic.metric_query(semantic.SALES_ORDERS, built["silver_sales_enriched"], ["order_line_count"])
    assert lines.first()[0] == 1134


def test_governance(built):
    customers = built["silver_customers"].drop("transformed_at")
    assigned = governance.detect_classes(customers, "silver_customers", threshold=1.0).where("assigned")
    assert rows(assigned, "column") == [("country",), ("customer_id",), ("email",)]
    assert governance.conformance(customers, "country", "country").where("not conforms").isEmpty()
    assert governance.conformance(built["silver_orders"], "payment_method", "payment_method").where("not conforms").isEmpty()
    keys = profile.primary_keys(profile.profile(customers, "silver_customers"))
    assert ("customer_id",) in rows(keys, "column")
