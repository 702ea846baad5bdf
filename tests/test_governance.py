"""Data classes, masking, reference values, tags, lineage."""

import pytest
from pyspark.sql import functions as F
from shop import rows

from orestrata import contracts
from orestrata.operators import governance


@pytest.mark.parametrize(
    "column, good, bad",
    [
        ("customer_id", ["1001", "0000"], ["101", "10010", "a001"]),
        ("email", ["a.b+c@x-y.co", "A@B.DE"], ["a@b", "a b@c.de", "@c.de"]),
        ("country", ["DE", "NL"], ["de", "XX"]),
        ("lifetime_value", ["0", "10.5", "9999999999.99"], ["01", "-1", "1.234"]),
        ("product_id", ["2001"], ["1001", "20011"]),
        ("category", ["Office"], ["office", "Toys"]),
        ("unit_price", ["0.5", "99999.99"], ["100000", "1."]),
        ("order_id", ["3001"], ["2001"]),
        ("status", ["completed"], ["shipped"]),
        ("quantity", ["1", "99"], ["0", "100"]),
        ("net_amount", ["0.43"], [".43"]),
        ("order_date", ["2026-12-31"], ["2026-13-01", "2026-1-1"]),
        ("total_revenue", ["87509.85"], ["87,509.85"]),
        ("order_count", ["0", "9999999"], ["10000000", "1.0"]),
    ],
)
def test_classes(spark, column, good, bad):
    df = spark.createDataFrame([(v,) for v in good + bad + [None]], f"{column} string")
    found = governance.detect_classes(df, "t", threshold=0.0).collect()
    assert [(r["present"], r["matched"], r["assigned"]) for r in found] == [(len(good + bad), len(good), True)]
    strict = governance.detect_classes(df, "t", threshold=1.0).where("assigned")
    assert strict.isEmpty()


def test_catalog(spark):
    a = spark.createDataFrame([("3001", "completed")], "order_id string, status string")
    b = spark.createDataFrame([("3002",)], "order_id string")
    detected = governance.detect_classes(a, "a").unionByName(governance.detect_classes(b, "b"))
    assert {r[0]: r[1] for r in governance.class_catalog(detected).collect()} == {
        "Order ID": ["a.order_id", "b.order_id"],
        "Order Status": ["a.status"],
    }


def test_masks(spark):
    df = spark.createDataFrame([(1, "Ab9@x.de", "k"), (2, None, "k")], "id int, email string, note string")
    assert rows(governance.mask_pii(df)) == [(1, "Xxn@x.xx", "k"), (2, None, "k")]
    hashed = governance.mask_columns(df, {"email": "hash", "absent": "drop"})
    assert hashed.where("id = 1").select(F.col("email") == F.sha2(F.lit("Ab9@x.de"), 256)).first()[0]
    assert governance.mask_columns(df, {"note": "drop"}).where("note is not null").isEmpty()
    with pytest.raises(ValueError):
        governance.mask_columns(df, {"email": "scramble"})
    tagged = contracts.with_tags(df.withColumnRenamed("email", "contact"), contracts.SILVER_CUSTOMERS)
    assert contracts.tagged_columns(tagged, contracts.PII) == []
    assert contracts.tagged_columns(contracts.with_tags(df, contracts.SILVER_CUSTOMERS), contracts.PII) == ["email"]


def test_conformance(spark):
    df = spark.createDataFrame([("DE",), ("DE",), ("XX",), (None,)], "country string")
    assert rows(governance.conformance(df, "country", "country"), "value", "n_records", "conforms", "description") == [
        ("DE", 2, True, "Germany"),
        ("XX", 1, False, None),
        (None, 1, False, None),
    ]


def test_tags(spark):
    names = {
        "customer_id": ["Customer"],
        "customer_country": ["Customer"],
        "email": ["Customer", "PII"],
        "product_name": ["Product"],
        "unit_price": ["FinancialMetric", "Product"],
        "order_item_id": ["Order"],
        "discount_pct": ["FinancialMetric", "Order"],
        "lifetime_value": ["FinancialMetric"],
        "_ingested_at": ["OperationalMetadata"],
        "transformed_at": ["OperationalMetadata"],
        "net_revenue": ["FinancialMetric"],
        "units_sold": [],
    }
    df = spark.createDataFrame([(n,) for n in names], "column string")
    assert {r[0]: r[1] for r in df.select("column", governance.domain_tags("column")).collect()} == names


def test_layers_and_terms(spark):
    cases = {
        ("demo_raw", "raw_orders"): ("Raw", ["Order", "RawLanding"]),
        ("demo_bronze", "bronze_products"): ("Bronze", ["BronzeLayer", "Product"]),
        ("demo_silver", "silver_sales_enriched"): ("Silver", ["Order", "RevenueMetric", "SilverLayer"]),
        ("demo_gold", "gold_customer_360"): ("Gold", ["Customer360", "GoldLayer"]),
        ("demo_gold", "gold_category_performance"): ("Gold", ["GoldLayer", "Product", "RevenueMetric"]),
        ("other", "customers"): ("Raw", ["Customer", "RawLanding"]),
    }
    df = spark.createDataFrame([(*k, "x") for k in cases], "schema_name string, table_name string, column string")
    tagged = governance.tag_columns(df)
    assert {(r["schema_name"], r["table_name"]): (r["layer"], r["terms"]) for r in tagged.collect()} == cases


def test_merge_tags(spark):
    df = spark.createDataFrame([(["b", "a"], ["a", "c"]), (None, ["x"])], "old array<string>, new array<string>")
    assert [r[0] for r in df.select(governance.merge_tags("old", "new")).collect()] == [["b", "a", "c"], ["x"]]


def test_lineage(spark):
    edges = governance.lineage_edges(spark)
    assert edges.count() == 16
    reach = governance.closure(edges)
    downstream = {r["target"]: r["distance"] for r in reach.where("source = 'raw_products'").collect()}
    assert downstream == {
        "bronze_products": 1,
        "silver_products": 2,
        "silver_sales_enriched": 3,
        "gold_daily_sales": 4,
        "gold_customer_360": 4,
        "gold_category_performance": 5,
    }
    upstream = reach.where("target = 'gold_customer_360'").count()
    assert upstream == 13


def test_closure_of_a_cycle_ends(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "source string, target string")
    assert governance.closure(edges).count() == 9


def test_declared_references(spark):
    assert governance.relationships(spark).count() == 11


def test_only_few_values_are_merged(spark, monkeypatch):
    """Columns of many values are tried as they are, with the same result; a merge of them would shuffle most rows."""
    df = spark.range(4000).selectExpr("cast(2000 + id % 400 as string) product_id", "if(id % 3 = 0, 'DE', 'xx') country")
    found = sorted(map(tuple, governance.detect_classes(df, "t", by_value=True).collect()))
    assert governance._often_repeated(df, df.columns) == ["product_id", "country"]
    monkeypatch.setattr(governance, "MERGED", 100)
    assert governance._often_repeated(df, df.columns) == ["country"]
    assert sorted(map(tuple, governance.detect_classes(df, "t", by_value=True).collect())) == found
