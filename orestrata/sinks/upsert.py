"""Keyed tables that take batches of changes: the last change of a key wins.

Rows are dealt into buckets by a hash of their key. A batch is written whole to a folder of its own, sorted by bucket; then the
table's document (`sinks.state`) lists it. Readers merge the listed batches, later ones last, over the base. `compact` folds them
into new files of the buckets they touch, and only of those; the document then names the new files and forgets the
batches, whose folders are deleted one compaction later, when nobody reads them any more. The table compacts by itself after
`fold_every` batches, so a read lists one base and few batches however many there were.

A batch is named by the run that brings it and its number in that run. A replayed batch replaces itself, or is left out if
it is folded already. Which numbers of a run are folded is kept as ranges: one, as long as a stream counts on. A new run (a
stream with a fresh checkpoint) starts its numbers again without touching older batches. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orestrata.operators.incremental import latest_per_key
from orestrata.sinks.state import State

BATCH = "batch_seq"
BUCKET = "key_bucket"
GONE = "key_gone"


class KeyedTable:
    """`bucket_by`: the columns of the key by which rows are dealt, all of them unless given; `lookup` goes by these."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: list[str],
        buckets: int = 16,
        bucket_by: list[str] | None = None,
        fold_every: int = 64,
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = keys
        self.buckets = buckets
        self.bucket_by = bucket_by or keys
        self.fold_every = fold_every
        self.state = State(spark, self.path)

    def upsert(
        self, changes: DataFrame, batch_id: int, order: list[str], run: str = "", gone: DataFrame | None = None
    ) -> None:
        """Apply one batch of a run; within it the last row of a key by `order` counts.

        The keys in `gone` are deleted, unless the batch has a row for them too.
        """
        now = self.state.read() or self._empty(changes.schema)
        own = now["runs"].setdefault(run, {"folded": [], "open": {}})
        if any(low <= batch_id <= high for low, high in own["folded"]):
            return
        sequence = own["open"].get(str(batch_id), now["next"])
        schema = T.StructType.fromJson(now["schema"])
        last = latest_per_key(changes, self.keys, order).select(*schema.names, F.lit(False).alias(GONE))
        if gone is not None:
            lost = gone.select(*self.keys).distinct().join(last.select(*self.keys), self.keys, "left_anti")
            last = last.unionByName(lost.withColumn(GONE, F.lit(True)), allowMissingColumns=True)
        folder = f"log/{sequence}-{uuid.uuid4().hex}"
        rows = last.withColumns({BUCKET: self._bucket(), BATCH: F.lit(sequence).cast("bigint")})
        rows.sortWithinPartitions(BUCKET).write.parquet(f"{self.path}/{folder}")
        now["trash"] += [now["batches"][str(sequence)]] if str(sequence) in now["batches"] else []
        now["batches"][str(sequence)] = folder
        own["open"][str(batch_id)] = sequence
        now["next"] = max(now["next"], sequence + 1)
        self.state.write(now)
        if len(now["batches"]) >= self.fold_every:
            self.compact()

    def batch(self, batch_id: int, run: str = "") -> DataFrame | None:
        """The rows that a batch of a run has left, one per key; None when it is folded by now."""
        now = self._current()
        sequence = now["runs"].get(run, {"open": {}})["open"].get(str(batch_id))
        if sequence is None:
            return None
        schema = T.StructType.fromJson(now["schema"]).add(GONE, T.BooleanType())
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{now['batches'][str(sequence)]}")
        return rows.where(~F.col(GONE)).drop(GONE)

    def read(self) -> DataFrame:
        """One row per key: its last change."""
        return self._merged(self._current(), None).drop(BUCKET)

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """The rows that have one of the wanted values of the bucket columns: only their buckets are read."""
        picked = wanted.select(*self.bucket_by).distinct()
        touched = [row[0] for row in picked.select(self._bucket()).distinct().collect()]
        return self._merged(self._current(), touched).drop(BUCKET).join(picked, self.bucket_by, "left_semi")

    def compact(self) -> int:
        """Fold all batches written so far into the base; returns how many batches it holds."""
        now = self._current()
        log = self._log(now)
        if log is not None:
            touched = sorted(row[0] for row in log.select(BUCKET).distinct().collect())
            generation = f"base/{now['next']}-{uuid.uuid4().hex}"
            merged = self._merged(now, touched)
            # A bucket gets few large files; one that outgrows a task is split.
            merged.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{generation}")
            written = set(self.state.names(generation))
            old = [*now["trash"]]
            now["trash"] = [now["base"][str(b)] for b in touched if str(b) in now["base"]] + list(now["batches"].values())
            for bucket in touched:
                name = f"{BUCKET}={bucket}"
                if name in written:
                    now["base"][str(bucket)] = f"{generation}/{name}"
                else:  # all of its keys are gone
                    now["base"].pop(str(bucket), None)
            now["batches"] = {}
            for own in now["runs"].values():
                own["folded"] = _ranges(own["folded"], map(int, own["open"]))
                own["open"] = {}
            self.state.write(now)
            for folder in old:
                self.state.delete(folder)
        return sum(high - low + 1 for own in now["runs"].values() for low, high in own["folded"])

    def _empty(self, schema: T.StructType) -> dict:
        return {
            "buckets": self.buckets,
            "schema": schema.jsonValue(),
            "next": 0,
            "base": {},  # bucket -> folder
            "batches": {},  # sequence -> folder
            "runs": {},  # run -> ranges of folded numbers, and the open ones with their sequence
            "trash": [],
        }

    def _current(self) -> dict:
        now = self.state.read()
        if now is None:
            raise ValueError(f"{self.path} holds no batch yet")
        if now["buckets"] != self.buckets:
            raise ValueError(f"{self.path} has {now['buckets']} buckets")
        return now

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def _log(self, now: dict, touched: list[int] | None = None) -> DataFrame | None:
        if not now["batches"]:
            return None
        schema = T.StructType.fromJson(now["schema"]).add(GONE, T.BooleanType()).add(BUCKET, T.IntegerType()).add(BATCH, T.LongType())
        log = self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in now["batches"].values()])
        return log if touched is None else log.where(F.col(BUCKET).isin(touched))

    def _merged(self, now: dict, touched: list[int] | None) -> DataFrame:
        """The rows of some buckets (all of them for None), with their bucket."""
        schema = T.StructType.fromJson(now["schema"])
        folders = [f for b, f in now["base"].items() if touched is None or int(b) in set(touched)]
        paths = [f"{self.path}/{f}" for f in folders]
        base = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        base = base.withColumn(BUCKET, self._bucket())
        log = self._log(now, touched)
        if log is None:
            return base
        # A batch holds a key once, so one batch alone needs no exchange.
        newer = (latest_per_key(log, self.keys, [BATCH]) if len(now["batches"]) > 1 else log).drop(BATCH)
        kept = base.join(newer.select(*self.keys), self.keys, "left_anti") if paths else base
        return kept.unionByName(newer.where(~F.col(GONE)).drop(GONE))


def _ranges(folded: list[list[int]], numbers) -> list[list[int]]:
    """Ranges with some more numbers in them, neighbours joined."""
    out: list[list[int]] = []
    for low, high in sorted([*folded, *([n, n] for n in numbers)]):
        if out and low <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def merge_into(spark: SparkSession, target: str, changes: DataFrame, keys: list[str]) -> None:
    """The same upsert on a catalog table whose format has MERGE; `changes` holds one row per key."""
    view = f"changes_{uuid.uuid4().hex}"
    changes.createOrReplaceTempView(view)
    condition = " AND ".join(f"t.{key} = s.{key}" for key in keys)
    changes.sparkSession.sql(
        f"MERGE INTO {target} t USING {view} s ON {condition} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )
