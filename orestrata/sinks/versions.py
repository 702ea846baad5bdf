"""Tables that keep their versions, on plain Parquet folders.

Each commit writes its rows to its own folder and then one commit record; readers see a version only
through its record, which names the folder. An overwrite starts a new base, an append adds its folder to the base's, so an
append costs what it adds. Meant for one writer at a time; with a table format on the classpath use
its own commits and `VERSION AS OF`.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.functions.times import month_ordinal, ordinal_label
from orestrata.operators import incremental, reconcile
from orestrata.sinks.tables import MONTH, write_files

VERSION = "table_version"
COMMITS = (
    "version bigint, committed_at timestamp, operation string, base_version bigint, "
    "parent_version bigint, row_count bigint, tag string, folder string"
)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def commit(
        self,
        df: DataFrame,
        operation: str = "overwrite",
        partition_by: list[str] | None = None,
        tag: str | None = None,
    ) -> int:
        """Write the next version and return its number. A concurrent commit of the same number fails."""
        if operation not in ("overwrite", "append"):
            raise ValueError(f"unknown operation {operation!r}")
        last = self.latest()
        version = 1 if last is None else last["version"] + 1
        base = version if last is None or operation == "overwrite" else last["base_version"]
        # A folder of its own: a commit that loses the race for its number leaves the winner's rows alone.
        folder = f"{version}-{uuid.uuid4().hex}"
        write_files(df, f"{self.path}/data/{VERSION}={folder}", partition_by)
        # Counted from the file footers; no column is read.
        written = self.spark.read.schema(df.schema).parquet(f"{self.path}/data/{VERSION}={folder}").count()
        record = (
            version,
            datetime.now(timezone.utc),
            operation,
            base,
            None if last is None else last["version"],
            written,
            tag,
            folder,
        )
        commit = self.spark.createDataFrame([record], COMMITS).drop("version").coalesce(1)
        commit.write.mode("errorifexists").parquet(f"{self.path}/commits/version={version}")
        return version

    def commits(self) -> DataFrame:
        """One row per version."""
        try:
            records = self.spark.read.schema(COMMITS).parquet(f"{self.path}/commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], COMMITS)
        return records

    def latest(self):
        """The newest commit record, None for an empty table."""
        return self.commits().orderBy(F.desc("version")).first()

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of a version, the newest by default."""
        chosen = self.latest() if version is None else self.commits().where(F.col("version") == version).first()
        if chosen is None:
            raise ValueError(f"{self.path} has no version {version or 1}")
        parts = self.commits().where(F.col("version").between(chosen["base_version"], chosen["version"]))
        folders = [f"{self.path}/data/{VERSION}={row[0]}" for row in parts.orderBy("version").select("folder").collect()]
        return self.spark.read.option("basePath", f"{self.path}/data").parquet(*folders).drop(VERSION)

    def read_as_of(self, moment: datetime | str) -> DataFrame:
        """Rows as they were at a moment: the newest version committed by then."""
        at = F.lit(moment).cast("timestamp")
        found = self.commits().where(F.col("committed_at") <= at).orderBy(F.desc("version")).first()
        if found is None:
            raise ValueError(f"{self.path} had no version at {moment}")
        return self.read(found["version"])

    def snapshots(self, last: int | None = None) -> DataFrame:
        """(committed_at, version, operation, row_count), newest first, all or the `last` ones."""
        found = self.commits().select("committed_at", "version", "operation", "row_count").orderBy(F.desc("version"))
        return found if last is None else found.limit(last)

    def history(self, last: int | None = None) -> DataFrame:
        """(made_current_at, version, parent_version, is_current_ancestor), newest first.

        Versions follow one another without branches, so each is an ancestor of the current one.
        """
        found = (
            self.commits()
            .select(
                F.col("committed_at").alias("made_current_at"),
                "version",
                "parent_version",
                F.lit(True).alias("is_current_ancestor"),
            )
            .orderBy(F.desc("version"))
        )
        return found if last is None else found.limit(last)

    def compare(self, before: int, after: int, columns: list[str] | None = None) -> DataFrame:
        """One row: counts of both versions, and distinct rows found only before or only after."""
        old, new = self.read(before), self.read(after)
        changed = reconcile.except_counts(old, new, columns or new.columns).select(
            F.col("ref_only").alias("removed"), F.col("other_only").alias("added"), "copies_differ"
        )
        facts = reconcile.table_counts({"before_rows": old, "after_rows": new}).toDF("name", "n")
        facts = facts.unionByName(changed.unpivot([], changed.columns, "name", "n"))
        names = ["before_rows", "after_rows", *changed.columns]
        return facts.agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in names])


def load_incrementally(table: VersionedTable, source: DataFrame, mark: str, keys: list[str] | None = None) -> int:
    """First run: everything. Later runs: the rows past the table's high-water mark.

    They are appended, or, with `keys`, merged: a newer row replaces the one of the same key.
    """
    if table.latest() is None:
        return table.commit(source)
    present = table.read()
    fresh = incremental.newer_than(source, present.select(mark), mark)
    if keys is None:
        return table.commit(fresh, "append")
    return table.commit(incremental.merge_by_key(present, fresh, keys, [mark]))


def full_refresh(table: VersionedTable, source: DataFrame) -> int:
    return table.commit(source, "overwrite")


def partition_stats(df: DataFrame, month: str = MONTH) -> DataFrame:
    """Rows, files and bytes per month of a stored table, with the month as an ordinal and as YYYY-MM.

    Reads no data column, only the partition and the files' own metadata.
    """
    files = df.groupBy(
        F.col(month).alias("month"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
    ).agg(F.count(F.lit(1)).alias("n"))
    stats = files.groupBy("month").agg(
        F.sum("n").alias("row_count"), F.count("file").alias("file_count"), F.sum("bytes").alias("total_size")
    )
    ordinal = month_ordinal("month")
    return stats.select(
        ordinal.alias("month_ordinal"), ordinal_label(ordinal).alias("month"), "row_count", "file_count", "total_size"
    )


def as_of_sql(name: str, version: int | None = None, moment: str | None = None) -> str:
    """The time-travel SELECT for a catalog whose table format supports it."""
    if (version is None) == (moment is None):
        raise ValueError("give a version or a moment")
    clause = f"VERSION AS OF {int(version)}" if version is not None else f"TIMESTAMP AS OF '{moment}'"
    return f"SELECT * FROM {name} {clause}"
