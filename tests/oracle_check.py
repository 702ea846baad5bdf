"""Run registered queries in Spark and their SQL in DuckDB over the same tables and compare the rows.

    python tests/oracle_check.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


spark_done = 0.0


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _kind(value) -> str:
    return "none" if value is None else type(value).__name__


def compare(db: duckdb.DuckDBPyConnection, sql: str, df: DataFrame) -> str | None:
    """None when both sides hold the same columns, value types and rows, else what differs."""
    found = [tuple(_plain(row[n]) for n in sorted(df.columns)) for row in df.collect()]
    global spark_done
    spark_done = time.time()
    cursor = db.execute(sql)
    names = [c[0] for c in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = [names.index(n) for n in sorted(names)]
    wanted = [tuple(_plain(row[i]) for i in order) for row in cursor.fetchall()]
    if len(found) != len(wanted):
        return f"{len(found)} rows != {len(wanted)}"
    found.sort(key=repr)
    wanted.sort(key=repr)
    for mine, theirs in zip(found, wanted):
        if mine != theirs or [_kind(v) for v in mine] != [_kind(v) for v in theirs]:
            return f"{mine} != {theirs}"
    return None


def main(folder: str, only: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, sqls, failed = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            df = run(spark, folder)
            problem = compare(db, sqls[name], df) if name in sqls else f"no SQL, {df.count()} rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32} {spark_done - started:6.2f}s spark {time.time() - spark_done:6.2f}s sql  {problem or 'ok'}", flush=True)
    print(f"{failed} differ")
    return 1 if failed else 0


if __name__ == "__main__":
    arguments = sys.argv[1:]
    sys.exit(main(arguments[0] if arguments else "/root/testdata/sf0.001", arguments[1:]))
