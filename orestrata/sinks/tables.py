"""Tables, views and reporting copies."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orestrata.functions import money
from orestrata.functions.times import month_start
from orestrata.sinks.state import State

MONTH = "order_month"


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")


def write_files(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the Parquet files of a folder; must not read from the folder it replaces.

    Rows of a partitioned table are rebalanced by partition first: a partition gets few, large files,
    and one that holds much of the data is written by many tasks.
    """
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Create or replace a Parquet table and read it back."""
    write_files(df, path, partition_by)
    return df.sparkSession.read.parquet(path)


def replace_monthly_table(
    df: DataFrame, path: str, day: str = "order_date", derive: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """A table partitioned by the month of `day`, kept as the column `order_month`.

    `derive` adds what follows from a row's own columns; it works behind the exchange by month, which then doesn't carry that.
    """
    if derive is None:
        return replace_table(df.withColumn(MONTH, month_start(day)), path, [MONTH])
    dealt = df.withColumn(MONTH, month_start(day)).hint("rebalance", MONTH)
    # `derive` may keep its own columns only.
    derive(dealt).withColumn(MONTH, month_start(day)).write.mode("overwrite").partitionBy(MONTH).parquet(path)
    return df.sparkSession.read.parquet(path)


def replace_catalog_table(df: DataFrame, name: str, day: str | None = None, fmt: str = "iceberg") -> None:
    """Create or replace a catalog table in a format with hidden partitioning, by month of `day`."""
    writer = df.writeTo(name).using(fmt)
    if day:
        writer = writer.partitionedBy(F.partitioning.months(day))
    writer.createOrReplace()


def bucketed_table(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """A catalog table in buckets of a key: tables with equal buckets join on it without an exchange.

    Rows are dealt by the key before they are written, so a bucket is one sorted file.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def publish(df: DataFrame, path: str) -> DataFrame:
    """Replace a published table: its rows are written whole to a folder of their own, then one document names that folder.

    A reader (`published`) finds the old rows or the new ones at any moment, and a writer lost anywhere leaves the old ones. The rows may
    come from the table itself. The folder before the last one is deleted.
    """
    state = State(df.sparkSession, path)
    now = state.read() or {"current": None, "last": None}
    folder = f"rows-{uuid.uuid4().hex}"
    df.write.parquet(f"{state.path}/{folder}")
    state.write({"current": folder, "last": now["current"]})
    if now["last"]:
        state.delete(now["last"])
    return published(df.sparkSession, path)


def published(spark: SparkSession, path: str) -> DataFrame:
    state = State(spark, path)
    now = state.read()
    if now is None:
        raise ValueError(f"{path} is not published")
    return spark.read.parquet(f"{state.path}/{now['current']}")


def append_table(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def append_to_emptied(df: DataFrame, path: str) -> DataFrame:
    """Recreate the table empty, then append, so a rerun does not double its rows."""
    spark = df.sparkSession
    spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)
    return append_table(df, path)


def register_files(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> bool:
    """Make existing files a table of the catalog; False if the name is taken already."""
    if spark.catalog.tableExists(name):
        return False
    spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{path}'")
    columns = spark.table(name)
    if any(f.name == MONTH for f in columns.schema.fields):
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return True


def create_table_as(spark: SparkSession, name: str, select: str, path: str) -> DataFrame:
    """CREATE TABLE ... AS SELECT at a given location, replacing a table of that name."""
    drop_any(spark, name)
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}' AS {select}")
    return spark.table(name)


def drop_any(spark: SparkSession, name: str) -> None:
    """Drop whatever holds the name, view or table."""
    if not spark.catalog.tableExists(name):
        return
    if spark.catalog.getTable(name).tableType in ("VIEW", "TEMPORARY"):
        spark.sql(f"DROP VIEW IF EXISTS {name}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def replace_view(spark: SparkSession, name: str, select: str) -> DataFrame:
    """A view of that name, in place of any view or table that holds it."""
    drop_any(spark, name)
    spark.sql(f"CREATE VIEW {name} AS {select}")
    return spark.table(name)


def swap_table(df: DataFrame, path: str) -> DataFrame:
    """Replace a stored table by rows that are written whole first, to a folder beside it.

    The rows may come from the table itself. If writing fails, the old table is as it was; then two renames put the
    new folder in its place, so readers that list files find one table or the other.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    fresh, old = f"{path}__new-{uuid.uuid4().hex}", f"{path}__old-{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    jvm = spark._jvm.org.apache.hadoop.fs
    here = jvm.Path(path)
    files = here.getFileSystem(spark._jsc.hadoopConfiguration())
    had = files.exists(here)
    if had and not files.rename(here, jvm.Path(old)):
        raise OSError(f"{path} can't be moved")
    if not files.rename(jvm.Path(fresh), here):
        if had:
            files.rename(jvm.Path(old), here)
        raise OSError(f"{path} can't be replaced")
    if had:
        files.delete(jvm.Path(old), True)
    return spark.read.parquet(path)


def refresh_mart(compute: Callable[[], DataFrame], path: str) -> DataFrame:
    """Recompute a mart, from its own stored rows if need be, and replace them."""
    return swap_table(compute(), path)


# Reporting copies: mart -> (target column, mart column, type). Types are fixed values.
REPORTING: dict[str, list[tuple[str, str, T.DataType]]] = {
    "customer_360": [
        ("customer_id", "customer_id", T.StringType()),
        ("first_name", "first_name", T.StringType()),
        ("last_name", "last_name", T.StringType()),
        ("email", "email", T.StringType()),
        ("country", "country", T.StringType()),
        ("signup_date", "signup_date", T.DateType()),
        ("completed_orders", "completed_orders", T.LongType()),
        ("returned_orders", "returned_orders", T.LongType()),
        ("pending_orders", "pending_orders", T.LongType()),
        ("cancelled_orders", "cancelled_orders", T.LongType()),
        ("lifetime_value", "lifetime_value", money.REPORT),
        ("last_completed_order_ts", "last_completed_order_ts", T.TimestampNTZType()),
        ("last_activity_ts", "last_activity_ts", T.TimestampNTZType()),
    ],
    "daily_sales": [
        ("order_date", "order_date", T.DateType()),
        ("category", "category", T.StringType()),
        ("order_count", "order_count", T.LongType()),
        ("units_sold", "units_sold", T.LongType()),
        ("net_revenue", "net_revenue", money.REPORT),
    ],
    "category_performance": [
        ("category", "category", T.StringType()),
        ("total_orders", "total_orders", T.LongType()),
        ("total_units_sold", "total_units", T.LongType()),
        ("total_net_revenue", "total_revenue", money.REPORT),
        ("avg_order_value", "avg_revenue_per_unit", money.REPORT),
    ],
}


def reporting_rows(mart: str, df: DataFrame) -> DataFrame:
    """A mart in the reporting layout, stamped with its load time."""
    columns = [F.col(source).cast(kind).alias(target) for target, source, kind in REPORTING[mart]]
    return df.select(*columns, F.current_timestamp().alias("_loaded_at"))


def refresh_reporting(mart: str, df: DataFrame, path: str) -> DataFrame:
    """Replace the reporting copy of a mart."""
    return swap_table(reporting_rows(mart, df), path)


def write_jdbc(df: DataFrame, url: str, relation: str, **options: str) -> None:
    """Empty a database table, keeping its definition, and fill it."""
    df.write.format("jdbc").options(url=url, dbtable=relation, truncate="true", **options).mode("overwrite").save()
