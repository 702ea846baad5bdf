"""Plans and skew: what has to hold on large data, shown on small."""

import os
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from shop import rows

from __spark_entry__ import queries
from orestrata import session
from orestrata.operators import enrich, gold, quality
from orestrata.sources.starmap import Entities

FOLDER = "/root/testdata/sf0.001"
PACKAGE = Path(__file__).resolve().parents[1] / "orestrata"


def _executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot(spark):
    """A shop in which one order, one product and one customer hold a third of all lines."""
    n = 60_000
    third = F.col("id") < n // 3
    lines = spark.range(0, n, 1, 8)
    items = lines.select(
        F.col("id").alias("order_item_id"),
        F.when(third, 0).otherwise(F.col("id") % 5000).alias("order_id"),
        F.when(third, 0).otherwise(F.col("id") % 700).alias("product_id"),
        (F.pmod(F.xxhash64("id"), F.lit(50)) + 1).cast("int").alias("quantity"),
        (F.pmod(F.hash("id"), F.lit(11)) / 100).cast("decimal(5,2)").alias("discount_pct"),
    )
    orders = spark.range(5000).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") < 1700, 0).otherwise(F.col("id") % 900).alias("customer_id"),
        F.lit("2026-01-02 03:04:05").cast("timestamp_ntz").alias("order_ts"),
        F.date_add(F.lit("2026-01-02").cast("date"), F.pmod(F.hash("id"), F.lit(300))).alias("order_date"),
        F.when(F.col("id") % 10 < 8, "completed").otherwise("returned").alias("status"),
        F.lit("card").alias("payment_method"),
    )
    products = spark.range(700).select(
        F.col("id").alias("product_id"),
        F.concat(F.lit("p"), "id").alias("product_name"),
        F.when(F.col("id") < 300, "A").otherwise("B").alias("category"),
        (F.pmod(F.xxhash64("id"), F.lit(100000)) / 100).cast("decimal(12,2)").alias("unit_price"),
    )
    customers = spark.range(900).select(
        F.col("id").alias("customer_id"),
        F.lit("f").alias("first_name"),
        F.lit("l").alias("last_name"),
        F.lit("e").alias("email"),
        F.lit("2020-01-01").cast("date").alias("signup_date"),
        F.lit("DE").alias("country"),
    )
    return Entities(customers, products, orders, items)


def test_hot_keys_are_split(spark, hot):
    """Without broadcasts, with thresholds scaled down, the skewed partitions of all joins are split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "16",
    }
    session.tune(spark)
    stamped = [df.withColumn("transformed_at", F.lit(1)) for df in (hot.order_items, hot.orders, hot.products)]
    staged = gold.daily_sales(enrich.sales_enriched_staged(*stamped, hot.customers))
    wanted = rows(staged)
    with session.conf(spark, **{k.replace(".", "__"): v for k, v in settings.items()}):
        daily = gold.daily_sales(enrich.sales_enriched(hot.order_items, hot.orders, hot.products, hot.customers))
        plan = _executed(daily)
        assert rows(daily) == wanted
    assert "SortMergeJoin(skew=true) [order_id" in plan
    assert "SortMergeJoin(skew=true) [product_id" in plan


def test_fact_exchanges_lines_once_per_large_key(spark, hot):
    """Lines are exchanged for product and order only, and the daily mart reuses the order partitioning."""
    with session.conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        fact = enrich.sales_enriched(hot.order_items, hot.orders, hot.products, hot.customers)
        plan = gold.daily_sales(fact)._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert sorted(keys) == ["customer_id", "customer_id", "order_date", "order_id", "order_id", "product_id", "product_id"]


def test_orphan_check_merges_keys_before_the_join(spark, hot):
    """Unless the parents fit a broadcast, where the join costs no exchange and may come first."""
    with session.conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        lost = quality.orphans(hot.order_items, "order_id", hot.orders, "order_id")
        plan = lost._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftAnti") < plan.index("Aggregate [order_id")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", ["daily_sales", "category_performance", "customer_360", "metric_month", "adhoc_daily_gross"])
def test_scans_are_pruned_and_stay_in_the_engine(spark, name):
    plan = _executed(queries()[name](spark, FOLDER))
    assert "Python" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "l_extendedprice" not in plan and "l_tax" not in plan and "o_totalprice" not in plan


def test_forbidden_calls():
    """No local checkpoints anywhere; in the retail part no cross joins, RDDs, Python functions or broadcast hints."""
    files = [p for p in PACKAGE.rglob("*.py")]
    assert not any("localCheckpoint" in p.read_text() for p in files)
    code = "\n".join(p.read_text() for p in files if p.parent.name != "llm")
    for word in ("localCheckpoint", "crossJoin", ".rdd", "toPandas", "pandas_udf", "udf(", "broadcast("):
        assert word not in code, word
