"""Stored tables, views, versions, incremental loads and upserts."""

import time
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from shop import entities, rows

from orestrata import session
from orestrata.operators import incremental, reports
from orestrata.plans import medallion
from orestrata.sinks import tables, versions
from orestrata.sinks.upsert import KeyedTable


@pytest.fixture(scope="module")
def orders(spark):
    return medallion.to_silver(entities(spark)).orders.drop("transformed_at")


def _executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_monthly_table_reads_only_its_months(spark, orders, folder):
    stored = tables.replace_monthly_table(orders, f"{folder}/t")
    picked = reports.between_dates(stored, "2026-02-02", "2026-02-04")
    assert rows(picked, "order_id") == [(103,), (104,), (105,)]
    plan = _executed(picked)
    assert "PartitionFilters: [isnotnull(order_month" in plan
    assert "PushedFilters: [IsNotNull(order_date), GreaterThanOrEqual(order_date,2026-02-02)" in plan
    stats = versions.partition_stats(stored)
    assert rows(stats, "month_ordinal", "month", "row_count", "file_count") == [
        (672, "2026-01", 2, 1),
        (673, "2026-02", 5, 1),
    ]
    assert stats.where("total_size <= 0").isEmpty()


def test_append_after_emptying(spark, orders, folder):
    tables.append_to_emptied(orders, folder + "/t")
    assert tables.append_to_emptied(orders, folder + "/t").count() == orders.count()
    assert tables.append_table(orders, folder + "/t").count() == 2 * orders.count()


def test_views_and_registered_files(spark, orders, folder):
    tables.create_namespace(spark, "shop")
    tables.replace_monthly_table(orders, f"{folder}/t")
    assert tables.register_files(spark, "shop.orders", f"{folder}/t")
    assert not tables.register_files(spark, "shop.orders", f"{folder}/t")
    assert spark.table("shop.orders").count() == 7
    created = tables.create_table_as(spark, "shop.done", "select * from shop.orders where status = 'completed'", f"{folder}/d")
    assert created.count() == 4
    view = tables.replace_view(spark, "shop.done", "select order_id from shop.orders where status = 'pending'")
    assert rows(view) == [(105,)]
    view = tables.replace_view(spark, "shop.done", "select 1 as one")
    assert rows(view) == [(1,)]
    tables.drop_any(spark, "shop.done")
    assert not spark.catalog.tableExists("shop.done")


def test_reporting_copy(spark, folder):
    built = medallion.build(entities(spark), f"{folder}/m")
    copy = tables.refresh_reporting("category_performance", built["gold_category_performance"], f"{folder}/r")
    assert copy.columns == ["category", "total_orders", "total_units_sold", "total_net_revenue", "avg_order_value", "_loaded_at"]
    assert copy.schema["total_net_revenue"].dataType.simpleString() == "decimal(18,2)"
    assert copy.where("category = 'Home'").first()["avg_order_value"] == Decimal("98.34")
    again = tables.refresh_reporting("category_performance", built["gold_category_performance"], f"{folder}/r")
    assert again.count() == 3


def test_versions(spark, orders, folder):
    table = versions.VersionedTable(spark, f"{folder}/v")
    assert table.latest() is None
    with pytest.raises(ValueError):
        table.read()
    january = orders.where("order_date < '2026-02-01'")
    february = orders.where("order_date >= '2026-02-01'")
    assert table.commit(january) == 1
    time.sleep(0.05)
    between = datetime.now(timezone.utc)
    time.sleep(0.05)
    assert table.commit(february, "append") == 2
    assert table.commit(orders.limit(1)) == 3
    assert rows(table.read(1)) == rows(january)
    assert rows(table.read(2)) == rows(orders)
    assert table.read().count() == 1
    assert rows(table.read_as_of(between)) == rows(january)
    with pytest.raises(ValueError):
        table.read_as_of("2000-01-01")
    assert [tuple(r) for r in table.snapshots().select("version", "operation", "row_count").collect()] == [
        (3, "overwrite", 1),
        (2, "append", 5),
        (1, "overwrite", 2),
    ]
    assert [tuple(r) for r in table.history().select("version", "parent_version", "is_current_ancestor").collect()] == [
        (3, 2, True),
        (2, 1, True),
        (1, None, True),
    ]
    assert table.compare(1, 2).first().asDict() == {
        "before_rows": 2,
        "after_rows": 7,
        "removed": 0,
        "added": 5,
        "copies_differ": 0,
    }


def test_partitioned_versions(spark, orders, folder):
    monthly = orders.withColumn("order_month", F.trunc("order_date", "month"))
    table = versions.VersionedTable(spark, f"{folder}/v")
    table.commit(monthly.where("order_date < '2026-02-01'"), partition_by=["order_month"])
    table.commit(monthly.where("order_date >= '2026-02-01'"), "append", partition_by=["order_month"])
    assert rows(table.read(), *orders.columns) == rows(orders)


def test_a_version_is_committed_once(spark, orders, folder):
    table = versions.VersionedTable(spark, f"{folder}/v")
    table.commit(orders)
    stale = versions.VersionedTable(spark, f"{folder}/v")
    stale.latest = lambda: None
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        stale.commit(orders)


def test_incremental_equals_full(spark, orders, folder):
    """Two slices past the high-water mark give the rows of one full load."""
    table = versions.VersionedTable(spark, f"{folder}/v")
    versions.load_incrementally(table, orders.where("order_date < '2026-02-02'"), "order_ts")
    versions.load_incrementally(table, orders, "order_ts")
    assert rows(table.read()) == rows(orders)
    versions.load_incrementally(table, orders, "order_ts")
    assert table.read().count() == orders.count()
    versions.full_refresh(table, orders)
    assert rows(table.read()) == rows(orders)


def test_incremental_merge(spark, orders, folder):
    """A later state of an order replaces the stored one."""
    table = versions.VersionedTable(spark, f"{folder}/v")
    versions.load_incrementally(table, orders, "order_ts", ["order_id"])
    late = orders.where("order_id = 105").withColumns(
        {"order_ts": F.lit("2026-03-01").cast("timestamp_ntz"), "status": F.lit("completed")}
    )
    versions.load_incrementally(table, orders.unionByName(late), "order_ts", ["order_id"])
    assert rows(table.read()) == rows(orders.where("order_id <> 105").unionByName(late))


def test_high_water_mark_reaches_the_scan(spark, orders, folder):
    stored = tables.replace_table(orders, f"{folder}/t")
    fresh = incremental.newer_than(stored, stored.where("order_id < 104"), "order_ts")
    assert rows(fresh, "order_id") == [(104,), (105,), (106,)]
    assert "GreaterThan(order_ts" in _executed(fresh)
    empty = stored.where("false")
    assert incremental.newer_than(stored, empty, "order_ts").count() == 7
    assert incremental.newer_than(stored, None, "order_ts") is stored


def test_latest_per_key_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select(F.floor(F.col("id") / 600).alias("k"), F.col("id").alias("seq"))
    last = incremental.latest_per_key(df, ["k"], ["seq"])
    assert rows(last) == [(0, 599), (1, 999)]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_merge_by_key(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, seq int")
    changes = spark.createDataFrame([(2, "c", 2), (2, "d", 3), (3, "e", 1)], "k int, v string, seq int")
    assert rows(incremental.merge_by_key(target, changes, ["k"], ["seq"])) == [(1, "a", 1), (2, "d", 3), (3, "e", 1)]


def test_replayed_batches_change_nothing(spark, folder):
    schema = "k int, v string, seq int"
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], schema)
    second = spark.createDataFrame([(2, "c", 3), (2, "d", 4), (3, "e", 5)], schema)
    table = KeyedTable(spark, f"{folder}/k", ["k"])
    with pytest.raises(ValueError):
        table.read()
    table.upsert(first, 0, ["seq"])
    table.upsert(second, 1, ["seq"])
    wanted = [(1, "a", 1), (2, "d", 4), (3, "e", 5)]
    assert rows(table.read()) == wanted
    table.upsert(second, 1, ["seq"])
    assert rows(table.read()) == wanted
    # the whole log once more, under new batch ids
    table.upsert(first.unionByName(second), 2, ["seq"])
    assert rows(table.read()) == wanted
    assert table.compact() == 3
    assert rows(table.read()) == wanted
    table.upsert(spark.createDataFrame([(1, "z", 6)], schema), 3, ["seq"])
    assert rows(table.read()) == [(1, "z", 6), (2, "d", 4), (3, "e", 5)]
    assert table.compact() == 4
    assert rows(table.read()) == [(1, "z", 6), (2, "d", 4), (3, "e", 5)]


def test_a_new_run_after_folding_loses_nothing(spark, folder):
    schema = "k int, v string, seq int"
    table = KeyedTable(spark, f"{folder}/k", ["k"])
    table.upsert(spark.createDataFrame([(1, "old", 1), (2, "b", 1)], schema), 0, ["seq"], run="one")
    table.compact()
    table.upsert(spark.createDataFrame([(1, "new", 2), (3, "c", 2)], schema), 0, ["seq"], run="two")
    assert rows(table.read()) == [(1, "new", 2), (2, "b", 1), (3, "c", 2)]


def test_a_mart_can_be_refreshed_from_its_own_rows(spark, folder):
    path = f"{folder}/mart"
    tables.replace_table(spark.range(5).toDF("n"), path)
    assert tables.refresh_mart(lambda: spark.read.parquet(path).where("n > 1"), path).count() == 3
    assert spark.read.parquet(path).count() == 3


def test_a_commit_that_loses_the_race_leaves_the_winner(spark, folder, monkeypatch):
    table = versions.VersionedTable(spark, f"{folder}/t")
    table.commit(spark.range(2).toDF("n"))
    other = versions.VersionedTable(spark, f"{folder}/t")
    before = other.latest()
    table.commit(spark.range(5).toDF("n"))
    monkeypatch.setattr(other, "latest", lambda: before)
    with pytest.raises(Exception):
        other.commit(spark.range(100, 103).toDF("n"))
    assert table.read().count() == 5


def test_shared_folder_is_the_session_s(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark) == base
    assert session.work_folder(spark, "x").startswith(f"{base}/orestrata/x-")


def test_time_travel_sql():
    assert versions.as_of_sql("t", version=3) == "SELECT * FROM t VERSION AS OF 3"
    assert "TIMESTAMP AS OF '2026-01-01'" in versions.as_of_sql("t", moment="2026-01-01")
    with pytest.raises(ValueError):
        versions.as_of_sql("t")


def test_build_is_complete(spark, folder):
    built = medallion.build(entities(spark), f"{folder}/m")
    by_layer = medallion.layers(built)
    assert {k: len(v) for k, v in by_layer.items()} == {"raw": 4, "bronze": 4, "silver": 6, "gold": 3}
    reports.require_rows(reports.layer_counts(by_layer), ["bronze", "silver", "gold"])
    assert built["time_spine_daily"].agg(F.min("date_day")).first()[0] == date(2025, 1, 1)


def test_one_batch_is_read_without_an_exchange(spark, folder):
    """Within a batch a key comes once; only several batches have to be merged."""
    table = KeyedTable(spark, f"{folder}/k", ["k"])
    table.upsert(spark.createDataFrame([(1, 1), (1, 2), (None, 3), (None, 4)], "k int, v int"), 0, ["v"])
    assert "Exchange" not in table.read()._jdf.queryExecution().executedPlan().toString()
    assert rows(table.read()) == [(1, 2), (None, 4)]
    table.upsert(spark.createDataFrame([(1, 5)], "k int, v int"), 1, ["v"], gone=spark.createDataFrame([(7,)], "k int"))
    assert rows(table.read()) == [(1, 5), (None, 4)]


def test_amounts_are_added_behind_the_exchange_by_month(spark, folder):
    lines = spark.sql("select id, date'2026-01-31' order_date, id * 2 units from range(20) union all select 20, null, 0")
    seen = []

    def derive(dealt):
        seen.append(dealt._jdf.queryExecution().analyzed().toString())
        return dealt.select("id", "order_date", (F.col("units") + 1).alias("more"))

    stored = tables.replace_monthly_table(lines, f"{folder}/t", derive=derive)
    assert "RebalancePartitions" in seen[0] or "rebalance" in seen[0].lower()
    assert rows(stored.select("id", "more")) == sorted([(i, 2 * i + 1) for i in range(20)] + [(20, 1)], key=repr)
    assert sorted(str(r[0]) for r in stored.select("order_month").distinct().collect()) == ["2026-01-01", "None"]


def test_stored_files_are_packed(spark, orders, folder):
    session.tune(spark)
    stored = tables.replace_table(orders, f"{folder}/t")
    assert all(name.endswith(".zstd.parquet") for name in stored.inputFiles())


def test_packed_files_do_not_pass_for_small_sides(spark, folder):
    """What repeats a few names packs well: its files are a small part of the rows that a broadcast would bring to the driver."""
    session.tune(spark)
    products = spark.range(300_000).selectExpr("id product_id", "concat('name ', id % 7) name", "concat('type ', id % 5) category")
    stored = tables.replace_table(products, f"{folder}/t").select("product_id", "category")
    size = int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert size > 300_000 * 4
