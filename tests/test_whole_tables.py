"""Shared scans, sketches, discovered keys, digests, gap filling and published tables."""

import random
from datetime import date
from itertools import product

import pytest
from pyspark.sql import functions as F
from shop import entities, rows

from orestrata import session
from orestrata.operators import enrich, governance, quality, reconcile, sketches, spine
from orestrata.operators.quality import AcceptedValues, NotNull, Relationship, Unique
from orestrata.plans import medallion, queries
from orestrata.sinks import tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tests_read_each_table_once(spark, folder):
    clean = medallion.to_silver(entities(spark)).named("silver")
    stored = {name: tables.replace_table(df, f"{folder}/{name}") for name, df in clean.items()}
    tests = [
        NotNull("silver_orders", "order_id"),
        Unique("silver_orders", "order_id"),
        AcceptedValues("silver_orders", "status", ("completed",)),
        Relationship("silver_orders", "customer_id", "silver_customers", "customer_id"),
        NotNull("silver_customers", "email"),
        Relationship("silver_order_items", "order_id", "silver_orders", "order_id"),
        Relationship("silver_order_items", "product_id", "silver_products", "product_id"),
    ]
    result = quality.run_tests(stored, tests)
    found = {(r.test, r.table_name, r.column): r.failures for r in result.collect()}
    assert found == {
        ("not_null", "silver_orders", "order_id"): 0,
        ("unique", "silver_orders", "order_id"): 0,
        ("accepted_values", "silver_orders", "status"): 3,
        ("relationships", "silver_orders", "customer_id"): 2,
        ("not_null", "silver_customers", "email"): 0,
        ("relationships", "silver_order_items", "order_id"): 1,
        ("relationships", "silver_order_items", "product_id"): 1,
    }
    grouped = plan_of(quality._key_values(stored, tests))
    assert grouped.count("FileScan parquet") == 4 and grouped.count("Exchange hashpartitioning") == 1


def test_relationships_share_the_grouping_of_the_other_tests(spark, folder):
    parents = tables.replace_table(spark.range(100).selectExpr("cast(id as int) k", "cast(id as string) t"), f"{folder}/p")
    lines = spark.range(200).selectExpr("if(id = 7, null, id % 101) k", "if(id = 8, null, cast(id % 102 as string)) t", "id")
    frames = {"p": parents, "c": tables.replace_table(lines, f"{folder}/c")}
    pairs = [("k", "k"), ("t", "t"), ("k", "t"), ("id", "k")]
    for links in ([("k", "k")], pairs):
        tests = [Unique("p", "k"), NotNull("c", "k"), *[Relationship("c", a, "p", b) for a, b in links]]
        result = quality.run_tests(frames, tests)
        lost = {"k": 1, "t": 2, "id": 100}
        found = {(r.test, r.table_name, r.column): r.failures for r in result.collect()}
        assert found == {("unique", "p", "k"): 0, ("not_null", "c", "k"): 1} | {("relationships", "c", a): lost[a] for a, _ in links}
        plan = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "ReusedExchange" in plan and plan.count("FileScan parquet") == 2


def test_tests_of_empty_tables_pass(spark):
    empty = {"a": spark.createDataFrame([], "k int, v string"), "b": spark.createDataFrame([], "k int")}
    tests = [NotNull("a", "k"), Unique("a", "k"), AcceptedValues("a", "v", ("x",)), Relationship("a", "k", "b", "k")]
    assert {(r.failures, r.status) for r in quality.run_tests(empty, tests).collect()} == {(0, "PASS")}
    assert quality.run_tests(empty, tests).count() == 4


def test_classes_by_dictionary_equal_those_by_row(spark):
    dice = random.Random(1)
    mails = ["a@b.com", "x@y.org", "no mail", None, ""]
    data = [(dice.choice(mails), f"u{k}@z.net" if k % 3 else None, dice.randint(0, 3)) for k in range(400)]
    df = spark.createDataFrame(data, "email string, contact string, n int")
    found = {(r["column"], r.data_class): (r.present, r.matched) for r in governance.detect_classes(df, "t", by_value=True).collect()}
    assert governance._often_repeated(df, ["email", "contact", "n"]) == ["email", "n"]
    for column, data_class in product(df.columns, governance.DATA_CLASSES):
        value = F.col(column).cast("string")
        want = df.agg(F.count(value), F.count_if(value.rlike(data_class.value_pattern))).first()
        assert found[column, data_class.name] == tuple(want)


def test_sketches_of_parts_merge(spark, folder):
    df = spark.range(20_000).selectExpr("id", "id % 700 as k", "if(id % 4 = 0, null, cast(id % 90 as string)) as t", "id % 5 as part")
    path = f"{folder}/s"
    sketches.sketched(df.where("part < 4"), "part").write.parquet(path)
    sketches.sketched(df.where("part = 4"), "part").write.mode("append").parquet(path)  # a new part costs its own scan
    found = {r["column"]: r for r in sketches.profile_from(spark.read.parquet(path), df, "x").collect()}
    assert {(c, r.records, r.null_count, r.is_key) for c, r in found.items()} == {
        ("id", 20_000, 0, True), ("k", 20_000, 0, False), ("t", 20_000, 5_000, False)
    }
    assert all(abs(found[c].distinct_estimate / n - 1) < 0.05 for c, n in (("id", 20_000), ("k", 700), ("t", 90)))
    assert "id#" in plan_of(sketches.sketched(df, "part")) and plan_of(sketches.sketched(df, "part")).count("Exchange") == 1


def test_foreign_keys_of_whole_tables_against_brute_force(spark):
    dice = random.Random(5)
    frames = {
        "a": spark.createDataFrame([(i, f"n{i}", dice.randint(0, 30)) for i in range(40)] + [(None, None, 1)], "id int, name string, ref int"),
        "b": spark.createDataFrame([(i * 2, f"n{dice.randint(0, 60)}", dice.choice([None, 3, 4])) for i in range(50)], "id bigint, name string, few smallint"),
        "c": spark.createDataFrame([(i, "x" * 40 + str(i), float(i)) for i in range(31)], "key int, long string, real double"),
        "d": spark.createDataFrame([("x" * 40 + str(i % 7), float(i % 9), [1]) for i in range(60)], "long string, real double, list array<int>"),
        "e": spark.createDataFrame([], "id int"),
    }
    held = {}
    for t, df in frames.items():
        for c in df.columns:
            held[t, c] = [r[0] for r in df.select(c).collect()]
    for minimum in (0.3, 1.0):
        want = set()
        for (t, c), (u, p) in product(held, held):
            mine, theirs = {v for v in held[t, c] if not isinstance(v, list)} - {None}, held[u, p]
            if t == u or not mine or isinstance(theirs[:1], list) and theirs and isinstance(theirs[0], list):
                continue
            if sketches.kind_of(frames[t], c) != sketches.kind_of(frames[u], p):
                continue
            key = None not in theirs and len(set(theirs)) == len(theirs) and theirs
            common = len(mine & set(theirs)) if key else 0
            if common and common >= minimum * len(mine):
                want.add((t, c, u, p, len(mine), common))
        assert {tuple(r)[:6] for r in sketches.foreign_keys(frames, minimum).collect()} == want


def test_digests_find_one_cent_and_one_copy(spark):
    left = spark.range(5000).selectExpr("id", "date_add(date'2026-01-01', cast(id % 90 as int)) as day", "cast(id as decimal(12,2)) as v")
    columns = ["id", "day", "v"]
    part = F.trunc("day", "month")
    assert reconcile.drill_down(left, left.repartition(3), columns, part, ["id"]).isEmpty()
    cent = left.withColumn("v", F.when(F.col("id") == 77, F.col("v") + F.lit("0.01").cast("decimal(12,2)")).otherwise(F.col("v")).cast("decimal(12,2)"))
    assert rows(reconcile.drill_down(left, cent, columns, part, ["id"]), "id", "left_copies", "right_copies") == [(77, 0, 1), (77, 1, 0)]
    copy = left.unionByName(left.where("id = 5"))
    assert rows(reconcile.drill_down(left, copy, columns, part, ["id"]), "id", "left_copies", "right_copies") == [(5, 1, 2)]
    lost = left.where("day <> date'2026-02-03'")
    assert reconcile.drill_down(left, lost, columns, part, ["id"]).count() == left.where("day = date'2026-02-03'").count()
    nulls = left.withColumn("day", F.when(F.col("id") > 10, F.col("day")))
    assert reconcile.drill_down(nulls, nulls, columns, part, ["id"]).isEmpty()


def test_equal_builds_shuffle_digests_only(spark, folder):
    """Rows are looked up by the groups that differ: their size is measured first, so no row of either build is exchanged for that."""
    spark.range(50_000).selectExpr("id", "date_add(date'2026-01-01', cast(id % 90 as int)) as day", "uuid() as v").write.parquet(f"{folder}/a")
    spark.read.parquet(f"{folder}/a").repartition(3).write.parquet(f"{folder}/b")
    left, right = (spark.read.parquet(f"{folder}/{name}") for name in "ab")
    found = reconcile.drill_down(left, right, ["id", "day", "v"], F.trunc("day", "month"), ["id"])
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.collect() == []


def test_every_group_has_every_day(spark):
    data = spark.createDataFrame([(date(2026, 1, 2), "a", 3), (date(2026, 1, 4), "b", 5)], "day date, g string, n int")
    dense = spine.on_group_spine(data, data.select("g"), "day", date(2026, 1, 1), date(2026, 1, 4), ["n"])
    want = {(g, date(2026, 1, d)): 0 for g in "ab" for d in range(1, 5)} | {("a", date(2026, 1, 2)): 3, ("b", date(2026, 1, 4)): 5}
    assert {(r.g, r.day): r.n for r in dense.collect()} == want
    assert "NestedLoop" not in plan_of(dense) and "Cartesian" not in plan_of(dense)


def test_bucketed_lines_meet_orders_without_an_exchange(spark, folder):
    clean = medallion.to_silver(entities(spark))
    spark.sql("CREATE NAMESPACE IF NOT EXISTS bucket_test")
    with session.conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        items = tables.bucketed_table(clean.order_items, "bucket_test.items", f"{folder}/i", "order_id", 4)
        orders = tables.bucketed_table(clean.orders, "bucket_test.orders", f"{folder}/o", "order_id", 4)
        fact = enrich.sales_enriched_colocated(items, orders, clean.products, clean.customers)
        lines = items.select("order_id", "quantity").join(orders.select("order_id", "status"), "order_id")
        assert "Exchange" not in plan_of(lines)
        keys = [line for line in plan_of(fact).splitlines() if "Exchange hashpartitioning(order_id" in line]
        assert not keys
        assert rows(fact.drop("transformed_at")) == rows(medallion.to_fact(clean).drop("transformed_at"))


def test_published_rows_are_switched_at_once(spark, folder):
    path = f"{folder}/p"
    with pytest.raises(ValueError):
        tables.published(spark, path)
    tables.publish(spark.range(3).toDF("n"), path)
    reader = tables.published(spark, path)
    tables.publish(tables.published(spark, path).where("n > 0"), path)
    assert reader.count() == 3 and tables.published(spark, path).count() == 2  # a reader that has begun goes on
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("bigint").alias("n"))
    with pytest.raises(Exception, match="lost"):
        tables.publish(broken, path)
    assert tables.published(spark, path).count() == 2


def test_one_mart_of_the_staged_build_is_not_stored(spark, folder):
    """A union of one mart joins the staged fact for the columns that this mart reads."""
    own = {
        "nation": "select 1 n_nationkey, 'DE' n_name",
        "customer": "select id c_custkey, concat('Customer#', id) c_name, 1 c_nationkey, double(id - 1) c_acctbal, 'HOME' c_mktsegment from range(5)",
        "part": "select id p_partkey, 'widget' p_name, if(id < 2, 'A', 'B') p_type, 1.5D p_retailprice from range(4)",
        "orders": "select id o_orderkey, id % 6 o_custkey, if(id % 3 = 0, 'P', 'F') o_orderstatus, timestamp_ntz'1996-01-05 00:00:00' + make_dt_interval(cast(id as int) * 9) o_orderdate, '5-LOW' o_orderpriority from range(20)",
        "lineitem": "select id % 21 l_orderkey, id % 5 l_partkey, 1L l_suppkey, cast(id as int) l_linenumber, double(id % 4) l_quantity, 0.1D l_discount, timestamp_ntz'1996-05-05 00:00:00' l_shipdate from range(90)",
    }
    for name, text in own.items():
        spark.sql(text).write.parquet(f"{folder}/{name}.parquet")
    both = {name: queries.QUERIES[f"{name}_union"](spark, folder) for name in ("daily_sales", "category_performance", "customer_360")}
    assert not any(seen[1] == folder for seen in queries._staged)
    assert "product_name" not in plan_of(both["customer_360"])
    clean = queries.Data(spark, folder).clean
    fact = enrich.sales_enriched(clean.order_items, clean.orders, clean.products, clean.customers)
    marts = medallion.to_marts(fact, clean.customers, medallion.LARGE)
    for name, union in both.items():
        found = union.drop("path")
        wanted = rows(marts[name].select(*found.columns))
        assert wanted and rows(union.where("path = 'stored'").drop("path")) == rows(union.where("path = 'staged'").drop("path")) == wanted
