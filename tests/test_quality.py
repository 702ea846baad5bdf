"""Data tests, reconciliation, profiles and scores against brute force."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from shop import entities, rows

from orestrata import contracts
from orestrata.operators import governance, profile, quality, reconcile
from orestrata.operators.quality import AcceptedValues, NotNull, Relationship, Unique
from orestrata.plans import medallion


@pytest.fixture(scope="module")
def clean(spark):
    return medallion.to_silver(entities(spark))


def test_failing_data_is_reported(spark, clean):
    orders = clean.orders
    broken = orders.unionByName(orders.where("order_id = 100")).unionByName(
        orders.where("order_id = 101").withColumn("order_id", F.lit(None).cast("int")).withColumn("status", F.lit("shipped"))
    )
    tables = {"orders": broken, "customers": clean.customers}
    tests = [
        NotNull("orders", "order_id"),
        NotNull("orders", "status"),
        Unique("orders", "order_id"),
        Relationship("orders", "customer_id", "customers", "customer_id"),
        AcceptedValues("orders", "status", ("completed", "returned", "pending", "cancelled")),
    ]
    assert rows(quality.run_tests(tables, tests)) == [
        ("accepted_values", "orders", "status", 1, "FAIL"),
        ("not_null", "orders", "order_id", 1, "FAIL"),
        ("not_null", "orders", "status", 0, "PASS"),
        ("relationships", "orders", "customer_id", 2, "FAIL"),
        ("unique", "orders", "order_id", 1, "FAIL"),
    ]


def test_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, 2), (1, 2), (1, 2)], "k int, fk int")
    assert rows(quality.duplicate_keys(df, "k")) == [(1, 3)]
    parent = spark.createDataFrame([(1,), (None,)], "id int")
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk int")
    assert rows(quality.orphans(child, "fk", parent, "id")) == [(2, 2)]
    assert rows(quality.unaccepted(df, "k", ["1"])) == []


def test_except_counts(spark):
    schema = "k int, v string"
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "y")], schema)
    b = spark.createDataFrame([(1, "x"), (2, None), (4, "y"), (4, "y")], schema)
    assert reconcile.except_counts(a, b, ["k", "v"]).first()[:] == (1, 1, 1)
    assert rows(reconcile.except_rows(a, b, ["k", "v"])) == [(3, "y")]
    assert rows(reconcile.except_rows(a, b, ["k", "v"], bag=True)) == [(1, "x"), (3, "y")]


def test_one_cent_is_found(spark, clean):
    marts = medallion.to_marts(medallion.to_fact(clean), clean.customers)
    cent = F.when(F.col("category") == "Office", F.lit("0.01").cast("decimal(14,2)")).otherwise(0)
    other = {**marts, "daily_sales": marts["daily_sales"].withColumn("net_revenue", (F.col("net_revenue") + cent).cast("decimal(14,2)"))}
    same = reconcile.reconcile({"a": marts, "b": marts})
    assert {r["status"] for r in same.collect()} == {"PASS"}
    reconcile.require_parity(same)
    found = reconcile.reconcile({"a": marts, "b": other})
    assert rows(found, "mart", "ref_only", "other_only", "status") == [
        ("category_performance", 0, 0, "PASS"),
        ("customer_360", 0, 0, "PASS"),
        ("daily_sales", 1, 1, "FAIL"),
    ]
    with pytest.raises(ValueError, match="daily_sales vs b: FAIL"):
        reconcile.require_parity(found)
    doubled = {mart: df.unionByName(df) for mart, df in marts.items()}
    counted = reconcile.reconcile({"a": marts, "b": doubled}, bag=True)
    assert {r["status"] for r in counted.collect()} == {"FAIL"}
    missing = reconcile.reconcile({"a": marts, "b": {k: v for k, v in marts.items() if k != "customer_360"}})
    assert [r["status"] for r in missing.where("mart = 'customer_360'").collect()] == ["ERROR"]
    with pytest.raises(ValueError):
        reconcile.reconcile({"a": marts})
    delta = reconcile.delta_join(
        marts["daily_sales"], other["daily_sales"], ["order_date", "category"], "order_count", "net_revenue", ("a", "b")
    )
    assert [r["delta"] for r in delta.collect()] == [Decimal("-0.01")]


def test_parity_of_counts_and_values(clean):
    marts = medallion.to_marts(medallion.to_fact(clean), clean.customers)
    short = {**marts, "daily_sales": marts["daily_sales"].where("category <> 'Office'")}
    counts = reconcile.count_parity(marts, short)
    assert rows(counts.where("not matches"), "table_name", "our_rows", "their_rows") == [("daily_sales", 4, 3)]
    totals = reconcile.value_parity(marts, short, {"daily_sales": "net_revenue", "customer_360": "lifetime_value"})
    assert rows(totals) == [
        ("customer_360.lifetime_value", Decimal("299.05"), Decimal("299.05"), True),
        ("daily_sales.net_revenue", Decimal("299.05"), Decimal("298.62"), False),
    ]


def test_profile_against_brute_force(spark):
    long = "x" * 200
    data = [(1, "a", long + "1"), (2, "a", long + "2"), (3, None, long + "1"), (4, "b", None), (5, "a", None)]
    df = spark.createDataFrame(data, "id int, kind string, body string")
    found = {r["column"]: (r["records"], r["null_count"], r["distinct_count"]) for r in profile.profile(df, "t").collect()}
    wanted = {}
    for i, name in enumerate(df.columns):
        values = [row[i] for row in data]
        present = [v for v in values if v is not None]
        wanted[name] = (len(values), len(values) - len(present), len(set(present)))
    assert found == wanted
    assert rows(profile.primary_keys(profile.profile(df, "t"))) == [("t", "id", 5)]


def test_foreign_keys(spark):
    child = spark.createDataFrame([(1, 10), (2, 10), (3, 11), (4, None)], "id int, parent_id bigint")
    parent = spark.createDataFrame([(10, "a"), (11, "b"), (12, "c")], "id int, code string")
    found = profile.foreign_keys({"child": child, "parent": parent}, {"child": ["id", "parent_id"], "parent": ["id", "code"]})
    assert rows(found, "child_table", "child_column", "parent_table", "parent_column", "distinct_values", "contained") == [
        ("child", "parent_id", "parent", "id", 2, 2)
    ]
    partly = profile.foreign_keys(
        {"child": child.where("parent_id = 10"), "parent": parent.where("id <> 10")},
        {"child": ["parent_id"], "parent": ["id"]},
        minimum=0.0,
    )
    assert rows(partly) == []


def test_foreign_keys_against_brute_force(spark):
    """All pairs of columns of two kinds, with nulls, repeats and partial inclusion."""
    data = {
        "a": [(i, i % 7, f"k{i % 3}", None if i % 5 == 0 else i % 4) for i in range(40)],
        "b": [(i, i // 2, f"k{i}", i % 2) for i in range(10)],
        "c": [(i * 2, i, f"x{i}", None) for i in range(8)],
    }
    columns = ["p", "q", "r", "s"]
    tables = {n: spark.createDataFrame(v, "p int, q bigint, r string, s int") for n, v in data.items()}
    found = profile.foreign_keys(tables, {n: columns for n in data}, minimum=0.3)
    kind = {"p": "i", "q": "i", "r": "t", "s": "i"}
    wanted = []
    for ct, crows in data.items():
        for pt, prows in data.items():
            for ci, c in enumerate(columns):
                for pi, p in enumerate(columns):
                    if ct == pt or kind[c] != kind[p]:
                        continue
                    child = {r[ci] for r in crows} - {None}
                    parent = [r[pi] for r in prows]
                    common = child & set(parent)
                    if None in parent or len(set(parent)) != len(parent) or not common or len(common) < 0.3 * len(child):
                        continue
                    wanted.append((ct, c, pt, p, len(child), len(common)))
    got = rows(found, "child_table", "child_column", "parent_table", "parent_column", "distinct_values", "contained")
    assert got == sorted(wanted, key=repr)


def test_scores(spark):
    df = spark.createDataFrame(
        [(3001, "completed", "x"), (3002, "shipped", None), (99, None, None), (3001, "pending", "y")],
        "order_id int, status string, memo string",
    )
    vocabulary = {"status": list(governance.REFERENCE_SETS["order_status"])}
    scores = profile.column_scores(df, "orders", governance.DATA_CLASSES, vocabulary, ("order_id",))
    assert rows(scores) == [
        ("orders", "memo", 4, Decimal("50.00"), None, None, None, Decimal("50.00")),
        ("orders", "order_id", 4, Decimal("100.00"), Decimal("75.00"), None, Decimal("75.00"), Decimal("83.33")),
        ("orders", "status", 4, Decimal("75.00"), Decimal("66.67"), Decimal("66.67"), None, Decimal("69.45")),
    ]
    card = profile.scorecard(scores).first().asDict()
    assert card == {
        "table_name": "orders",
        "records": 4,
        "columns": 3,
        "validity": Decimal("70.84"),
        "completeness": Decimal("75.00"),
        "uniqueness": Decimal("75.00"),
        "consistency": Decimal("66.67"),
        "col_avg": Decimal("67.6"),
        "overall": Decimal("71.88"),
    }
    assert profile.kpis(profile.scorecard(scores), 2).first()[:] == (1, Decimal("71.88"), 4, 2, 3)


def test_published_overall_scores(spark):
    """Overall is the mean of the dimensions that apply."""
    df = spark.createDataFrame(
        [("87.69", "100", "100", "100"), ("87.50", None, "100", "100"), ("92.54", "100", "100", "100")],
        "a string, b string, c string, d string",
    ).select(*[F.col(c).cast(profile.PERCENT).alias(c) for c in "abcd"])
    found = [r[0] for r in df.select(profile.mean_of(*[F.col(c) for c in "abcd"])).collect()]
    assert found == [Decimal("96.92"), Decimal("95.83"), Decimal("98.14")]


def test_declared_tests_count():
    kinds = [type(t).__name__ for t in medallion.TESTS]
    assert len(kinds) == 34
    assert {k: kinds.count(k) for k in set(kinds)} == {"NotNull": 15, "Unique": 12, "Relationship": 6, "AcceptedValues": 1}


def test_marts_match_contract():
    assert contracts.MARTS["daily_sales"] == ["order_date", "category", "order_count", "units_sold", "net_revenue"]
