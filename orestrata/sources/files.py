"""Scans of files, tables and databases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orestrata.session import conf


def csv_text(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV with a header, every column text: no inference pass over the files."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and types found by Spark; reads the files twice, so for small loads."""
    # Types are found while the reader is set up; timestamps without a zone stay without one.
    with conf(spark, spark__sql__timestampType="TIMESTAMP_NTZ"):
        return spark.read.csv(path, header=True, inferSchema=True)


def csv_positional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV typed by column position: the header row is skipped, its names do not count."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=True, mode="FAILFAST")


def parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def table(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    """A table of the catalog, optionally only some of its columns."""
    frame = spark.table(name)
    return frame.select(*columns) if columns else frame


def sql(spark: SparkSession, statement: str, **tables: DataFrame) -> DataFrame:
    """A SELECT over frames given by name: `sql(spark, "select ... from {orders}", orders=df)`."""
    return spark.sql(statement, **tables)


def jdbc(
    spark: SparkSession,
    url: str,
    relation: str,
    split_on: str,
    lower: int | str,
    upper: int | str,
    partitions: int,
    **options: str,
) -> DataFrame:
    """A database table read in `partitions` ranges of one column, filters pushed down."""
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", relation)
        .option("partitionColumn", split_on)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", str(partitions))
        .options(**options)
        .load()
    )


def source_file() -> Column:
    """Base name of the file a row is read from; only right on a scan."""
    return F.col("_metadata.file_name")
