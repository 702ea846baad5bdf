"""Streams against the same work done in batch."""

import time

import pytest
from pyspark.sql import functions as F
from shop import entities, rows

from orestrata import contracts
from orestrata.operators import gold, silver
from orestrata.plans import medallion
from orestrata.sinks.upsert import KeyedTable
from orestrata.streaming import pipeline, sources

ENTITIES = ("customers", "products", "orders", "order_items")


def _land(raw, folder):
    """The raw entities as append logs."""
    for entity in ENTITIES:
        getattr(raw, entity).write.mode("append").parquet(f"{folder}/raw/{entity}")


def _clean(spark, raw, folder):
    streams = {}
    for entity in ENTITIES:
        log = sources.file_stream(spark, f"{folder}/raw/{entity}", getattr(raw, entity).schema)
        clean = pipeline.clean(entity, log)
        topic = f"{folder}/topic/{entity}"
        pipeline.append(pipeline.to_wire(clean), topic, f"{folder}/cp/{entity}", once=True).awaitTermination()
        carried = sources.file_stream(spark, topic, pipeline.wire_schema(clean.schema))
        streams[entity] = pipeline.from_wire(carried, clean.schema)
    return streams


def _fact(spark, streams, folder, **options):
    joined = pipeline.sales_enriched(streams["order_items"], streams["orders"], streams["products"], streams["customers"], **options)
    table = KeyedTable(spark, f"{folder}/fact", pipeline.KEYS["sales_enriched"])
    with pipeline.state_settings(spark, 4):
        pipeline.upsert(joined, table, ["transformed_at"], f"{folder}/cp/fact", once=True).awaitTermination()
    return table.read()


def _stored(spark, folder, entity):
    return KeyedTable(spark, f"{folder}/table/{entity}", pipeline.KEYS[entity])


def test_stream_equals_batch_and_replay_changes_nothing(spark, folder):
    raw = entities(spark)
    clean = medallion.to_silver(raw)
    # the stream contract drops blank emails too
    batch = medallion.Entities(
        silver.clean_customers(raw.customers, drop_blank_email=True), clean.products, clean.orders, clean.order_items
    )
    wanted = rows(medallion.to_fact(batch).drop("transformed_at"))
    _land(raw, folder)
    fact = _fact(spark, _clean(spark, raw, folder), folder)
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in contracts.SALES_ENRICHED]
    assert rows(fact.drop("transformed_at")) == wanted
    assert rows(gold.daily_sales(fact)) == rows(gold.daily_sales(medallion.to_fact(batch)))
    # the whole log once more, read by the same jobs from their checkpoints
    _land(raw, folder)
    again = _fact(spark, _clean(spark, raw, folder), folder)
    assert rows(again.drop("transformed_at")) == wanted


def test_upserts_keep_the_last_change(spark, folder):
    raw = entities(spark)
    _land(raw, folder)

    def run():
        clean = _clean(spark, raw, folder)["orders"]
        table = _stored(spark, folder, "orders")
        pipeline.upsert(clean, table, ["order_ts"], f"{folder}/cp/orders-table", once=True).awaitTermination()
        return rows(table.read().where("order_id is not null"), "order_id", "status")

    first = run()
    assert dict(first)[105] == "pending"
    late = raw.orders.where("order_id = '105'").withColumn("status", F.lit("COMPLETED "))
    late.write.mode("append").parquet(f"{folder}/raw/orders")
    second = run()
    assert second == [(k, "completed" if k == 105 else s) for k, s in first]


def test_changes_within_one_batch_follow_their_sequence(spark, folder):
    raw = entities(spark).orders.where("order_id = '105'")
    states = ["completed", "pending", "returned"]
    for number in (2, 0, 1):
        change = raw.withColumns({"status": F.lit(states[number]), "_sequence": F.lit(number).cast("bigint")})
        change.write.mode("append").parquet(f"{folder}/raw")
    log = sources.file_stream(spark, f"{folder}/raw", change.schema)
    clean = pipeline.clean("orders", log, carry=["_sequence"])
    pipeline.append(pipeline.to_wire(clean), f"{folder}/topic", f"{folder}/cp/clean", once=True).awaitTermination()
    carried = sources.file_stream(spark, f"{folder}/topic", pipeline.wire_schema(clean.schema))
    table = _stored(spark, folder, "orders")
    typed = pipeline.from_wire(carried, clean.schema)
    pipeline.upsert(typed, table, ["_sequence"], f"{folder}/cp/upsert", once=True).awaitTermination()
    assert rows(table.read(), "order_id", "status", "_sequence") == [(105, "returned", 2)]


def test_a_failed_batch_is_done_again(spark, folder):
    """A batch that fails after its write runs again from the checkpoint and leaves every row once."""
    raw = entities(spark)
    _land(raw, folder)
    clean = pipeline.clean("order_items", sources.file_stream(spark, f"{folder}/raw/order_items", raw.order_items.schema))
    table = _stored(spark, folder, "order_items")
    written = table.upsert
    attempts = []

    def failing(changes, batch_id, order, run):
        written(changes, batch_id, order, run)
        attempts.append(batch_id)
        if len(attempts) == 1:
            raise RuntimeError("lost after the write")

    table.upsert = failing

    def run():
        pipeline.upsert(clean, table, ["transformed_at"], f"{folder}/cp/once", once=True).awaitTermination()

    with pytest.raises(Exception, match="lost after the write"):
        run()
    run()
    assert attempts == [0, 0]
    wanted = silver.clean_order_items(raw.order_items)
    assert rows(table.read().drop("transformed_at")) == rows(wanted.drop("transformed_at"))


def test_wire_form_is_text(spark):
    clean = medallion.to_silver(entities(spark)).orders
    wire = pipeline.to_wire(clean)
    assert wire.schema["order_date"].dataType.simpleString() == "string"
    assert rows(wire.where("order_id = 100"), "order_ts", "order_date") == [("2026-01-02 10:00:00", "2026-01-02")]
    assert pipeline.wire_schema(clean.schema).simpleString() == wire.schema.simpleString()
    assert rows(pipeline.from_wire(wire, clean.schema).drop("transformed_at")) == rows(clean.drop("transformed_at"))


def test_salts_do_not_change_the_result(spark, folder):
    raw = entities(spark)
    _land(raw, folder)
    fact = _fact(spark, _clean(spark, raw, folder), folder, salts={"product_id": 1, "customer_id": 3, "order_id": 2})
    assert fact.count() == 7


def test_lines_against_stored_tables(spark, folder):
    raw = entities(spark)
    clean = medallion.to_silver(raw)
    _land(raw, folder)
    lines = _clean(spark, raw, folder)["order_items"]
    table = KeyedTable(spark, f"{folder}/fact", ["order_item_id"])
    step = pipeline.enrich_against(clean.orders, clean.products, clean.customers)
    pipeline.upsert(lines, table, ["transformed_at"], f"{folder}/cp/fact", once=True, transform=step).awaitTermination()
    assert rows(table.read().drop("transformed_at")) == rows(medallion.to_fact(clean).drop("transformed_at"))


def test_bounded_join_keeps_lines_near_their_order(spark, folder):
    clean = medallion.to_silver(entities(spark))
    at = F.when(F.col("order_id") == 100, F.lit("2026-01-02 12:00:00")).otherwise("2026-03-01 00:00:00").cast("timestamp_ntz")
    clean.order_items.withColumn("sold_at", at).write.parquet(f"{folder}/items")
    clean.orders.write.parquet(f"{folder}/orders")
    items = sources.file_stream(spark, f"{folder}/items", spark.read.parquet(f"{folder}/items").schema)
    orders = sources.file_stream(spark, f"{folder}/orders", spark.read.parquet(f"{folder}/orders").schema)
    joined = pipeline.sales_enriched_bounded(items, orders, clean.products, clean.customers, "sold_at", "1 hour", "1 day")
    with pipeline.state_settings(spark, 2):
        pipeline.append(joined, f"{folder}/out", f"{folder}/cp", once=True).awaitTermination()
    assert rows(spark.read.parquet(f"{folder}/out"), "order_item_id") == [(1000,), (1001,), (1002,)]


def test_orders_are_kept_once(spark, folder):
    """A copy of the one side is state; orders are a large part of it."""
    raw = entities(spark)
    _land(raw, folder)
    streams = _clean(spark, raw, folder)
    joined = pipeline.sales_enriched(streams["order_items"], streams["orders"], streams["products"], streams["customers"])
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert plan.count("Generate explode") == 2
    with pipeline.state_settings(spark, 2):
        for name in ("rocksdb.compression", "compression.codec"):
            assert spark.conf.get(f"spark.sql.streaming.stateStore.{name}") == "zstd"


def test_a_batch_step_leaves_no_shuffle_files(spark, folder):
    """The disks of the executors hold the shuffles of one statement, not those of all batches so far."""
    raw = entities(spark)
    clean = medallion.to_silver(raw)
    _land(raw, folder)
    lines = _clean(spark, raw, folder)["order_items"]
    table = KeyedTable(spark, f"{folder}/fact", ["order_item_id"])
    step = pipeline.enrich_against(clean.orders, clean.products, clean.customers)

    def files():
        found = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString(" ").split(" ")
        return {f for f in found if "/shuffle_" in f}

    before = files()
    pipeline.upsert(lines, table, ["transformed_at"], f"{folder}/cp/fact", once=True, transform=step).awaitTermination()
    for _ in range(50):  # they go in the background
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before and table.read().count() == 7
