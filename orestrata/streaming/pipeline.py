"""The medallion as streams: clean, carry, upsert, join.

Stage one cleans raw records with the batch rules and appends them in wire form (dates as ISO text).
Stage two types them again and upserts them by key; a second job joins the four clean streams into the
order-line fact. Marts are computed in batch over the upserted tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orestrata import contracts
from orestrata.functions import money
from orestrata.operators import enrich, silver
from orestrata.session import conf, tidy
from orestrata.sinks.upsert import KeyedTable

COMMIT_INTERVAL = "30 seconds"

KEYS = {
    "customers": ["customer_id"],
    "products": ["product_id"],
    "orders": ["order_id"],
    "order_items": ["order_item_id"],
    "sales_enriched": ["order_item_id"],
}

# State lives on disk, each commit saves what changed; counting its rows would read every key first.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # All records are kept, on the workers' disks and in the checkpoint: packed well, they take less of both.
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
}

# How many ways a join key is split, so that one key does not end in one task. Every copy of the one side is state; an
# order is a quarter as many rows as its lines, so its copies would outgrow them.
SALTS = {"product_id": 4, "customer_id": 4, "order_id": 1}


def clean(entity: str, raw: DataFrame, **options) -> DataFrame:
    """The batch cleaning rule of an entity; streams also drop blank emails."""
    rules: dict[str, Callable[..., DataFrame]] = {
        "customers": partial(silver.clean_customers, drop_blank_email=True),
        "products": silver.clean_products,
        "orders": silver.clean_orders,
        "order_items": silver.clean_order_items,
    }
    return rules[entity](raw, **options)


def to_wire(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text."""
    temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.withColumns(
        {f.name: F.col(f.name).cast("string") for f in df.schema.fields if isinstance(f.dataType, temporal)}
    )


def wire_schema(schema: T.StructType) -> T.StructType:
    temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return T.StructType(
        [T.StructField(f.name, T.StringType() if isinstance(f.dataType, temporal) else f.dataType) for f in schema]
    )


def from_wire(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Wire form back to the types of `schema`."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def append(df: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append a stream to a folder, exactly once per record; `once` stops when the input is used up."""
    return trigger(df.writeStream.format("parquet").option("path", path).outputMode("append"), once, checkpoint).start()


def append_kafka(df: DataFrame, servers: str, topic: str, key: str, checkpoint: str, **options: str) -> StreamingQuery:
    """Append a stream to a topic as JSON records; needs the Kafka connector on the classpath."""
    records = to_wire(df).select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))
    writer = (
        records.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**options)
        .outputMode("append")
    )
    return trigger(writer, False, checkpoint).start()


def upsert(
    df: DataFrame,
    table: KeyedTable,
    order: list[str],
    checkpoint: str,
    once: bool = False,
    transform: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> StreamingQuery:
    """Upsert a stream by key. A batch that runs again after a failure replaces its own output.

    Where a batch may hold several changes of a key, `order` must tell the last one, for instance by a
    sequence number that `clean` was told to carry.

    `transform` sees each batch as an ordinary frame, planned adaptively.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        # Off by default behind stateful operators; the batch itself is fixed by now.
        with conf(batch.sparkSession, spark__sql__adaptive__enabled="true"), tidy(batch.sparkSession, table.spark):
            run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")  # new with each checkpoint
            table.upsert(transform(batch), batch_id, order, run or "")

    return trigger(df.writeStream.foreachBatch(apply).outputMode("append"), once, checkpoint).start()


def sales_enriched(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    salts: dict[str, int] = SALTS,
) -> DataFrame:
    """The order-line fact as joins of four streams.

    Any side may arrive first, so all records are kept as state. Streams are not re-planned when a key
    is hot: the many side of each join is spread over `salts` buckets and the one side repeated in
    each.
    """
    placed = _salted(
        orders.drop("transformed_at"),
        customers.select("customer_id", F.col("country").alias("customer_country")),
        "customer_id",
        salts["customer_id"],
        "order_id",
    )
    priced = _salted(
        items.drop("transformed_at"), products.drop("transformed_at"), "product_id", salts["product_id"], "order_item_id"
    )
    return _priced_lines(_salted(priced, placed, "order_id", salts["order_id"], "order_item_id"))


def sales_enriched_bounded(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    item_time: str,
    lateness: str,
    line_within: str,
) -> DataFrame:
    """The fact with bounded state: lines must follow their order within a time, dimensions are tables.

    State older than the watermark is dropped, so later records are too; the unbounded join keeps all.
    """
    # Watermarks need instants; the fact keeps the plain timestamp.
    on_time = (
        items.drop("transformed_at")
        .withColumn("__sold", F.col(item_time).cast("timestamp"))
        .withWatermark("__sold", lateness)
    )
    placed = (
        orders.drop("transformed_at")
        .withColumnRenamed("order_id", "__order")
        .withColumn("__placed", F.col("order_ts").cast("timestamp"))
        .withWatermark("__placed", lateness)
    )
    joined = on_time.join(
        placed,
        (F.col("order_id") == F.col("__order"))
        & (F.col("__sold") >= F.col("__placed"))
        & (F.col("__sold") <= F.col("__placed") + F.expr(f"interval {line_within}")),
    )
    described = joined.join(products.drop("transformed_at"), "product_id").join(
        customers.select("customer_id", F.col("country").alias("customer_country")), "customer_id"
    )
    return _priced_lines(described)


def late_lines(
    items: DataFrame, joined: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame
) -> DataFrame:
    """What `sales_enriched_bounded` has dropped: lines of the log that are not among its rows, joined with stored tables.

    A line that came after the watermark, or whose order did, or that lies outside of the time allowed, is derived here; so
    the joined rows and these are the whole fact, and nothing is lost without trace.
    """
    missed = items.join(joined.select("order_item_id"), "order_item_id", "left_anti")
    return enrich.sales_enriched(missed, orders, products, customers)


def enrich_against(orders: DataFrame, products: DataFrame, customers: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A batch step for `upsert`: new lines against stored tables, without stream state."""
    return lambda items: enrich.sales_enriched(items, orders, products, customers)


def state_settings(spark: SparkSession, partitions: int | None = None):
    """Context in which stateful queries are started: their settings are fixed then.

    The number of state partitions cannot change later, so give `partitions` for the cluster the
    stream will grow to.
    """
    count = partitions or spark.sparkContext.defaultParallelism
    settings = {**STATE_SETTINGS, "spark.sql.shuffle.partitions": str(count)}
    return conf(spark, **{key.replace(".", "__"): value for key, value in settings.items()})


def _priced_lines(joined: DataFrame) -> DataFrame:
    return joined.withColumns(
        {
            "gross_amount": money.gross("quantity", "unit_price"),
            "net_amount": money.net("quantity", "unit_price", "discount_pct"),
            "transformed_at": F.current_timestamp(),
        }
    ).select(*contracts.SALES_ENRICHED.names)


def _salted(many: DataFrame, one: DataFrame, key: str, salts: int, spread_by: str) -> DataFrame:
    if salts == 1:
        return many.join(one, key)
    bucket = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    left = many.withColumn("__salt", bucket)
    right = one.withColumn("__salt", copies)
    return left.join(right, [key, "__salt"]).drop("__salt")


def trigger(writer, once: bool, checkpoint: str):
    prepared = writer.option("checkpointLocation", checkpoint)
    return prepared.trigger(availableNow=True) if once else prepared.trigger(processingTime=COMMIT_INTERVAL)
