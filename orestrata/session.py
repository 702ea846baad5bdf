"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import SparkSession

# Wanted in every job; each is left alone when the session was started with its own value.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even where that costs one more exchange above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Composed text ids and repeated names are most of what is stored: about half of what snappy leaves.
    "spark.sql.parquet.compression.codec": "zstd",
    # A side is broadcast by the size of its files; its rows, as the driver holds them, are many times that.
    "spark.sql.sources.fileCompressionFactor": "10.0",
}

_local_base: str | None = None


def tune(spark: SparkSession) -> SparkSession:
    """Apply SETTINGS that the user has not chosen."""
    chosen = spark.sparkContext.getConf()
    for key, value in SETTINGS.items():
        if not chosen.contains(key):
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir` of the session.

    Only a local master may fall back to a temporary folder of this machine.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="orestrata-")
    spark.sparkContext.setCheckpointDir(_local_base)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder on shared storage."""
    return f"{shared_folder(spark)}/orestrata/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def tidy(*sessions: SparkSession) -> Iterator[None]:
    """Within the block, shuffle files go when the statement that made them ends, not when the driver next collects its garbage.

    For writes and small collected results: a frame whose action is run again computes its shuffles again.
    """
    with ExitStack() as settings:
        for spark in sessions:
            settings.enter_context(conf(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"))
        yield


@contextmanager
def conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Set configuration (dots written as double underscores) for the length of a block."""
    wanted = {key.replace("__", "."): value for key, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
