"""Landing layer: raw rows plus audit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BATCH = "demo_seed_batch"


def annotate(raw: DataFrame, ingested_by: str, source_file: str | Column, batch_id: str | Column = DEFAULT_BATCH) -> DataFrame:
    """Add who, when, from which file and in which batch; `source_file` may be an expression."""
    return raw.withColumns(
        {
            "_ingested_at": F.current_timestamp(),
            "_ingested_by": F.lit(ingested_by),
            "_source_file": source_file if isinstance(source_file, Column) else F.lit(source_file),
            "_ingest_batch_id": batch_id if isinstance(batch_id, Column) else F.lit(batch_id),
        }
    )


def stage_annotate(raw: DataFrame, started_at: str, flow: str, run_id: str, source_file: str) -> DataFrame:
    """The variant of a scheduled run: start time, flow and run are constants of the run."""
    return raw.withColumns(
        {
            "_ingested_at": F.lit(started_at).cast("timestamp"),
            "_ingested_by": F.lit(flow),
            "_source_file": F.lit(source_file),
            "_ingest_batch_id": F.lit(run_id),
        }
    )
