"""Append-only audit trail: one row per job run."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from roentra import schemas
from roentra.sources.jsonlines import append_json_lines, read_json_lines


def log_run(
    spark: SparkSession,
    audit_path: str,
    job_name: str,
    row_count: int,
    schema: str | None = None,
    notes: str | None = None,
    at: datetime | None = None,
) -> None:
    stamp = (at or datetime.now(UTC)).isoformat()
    row = [(job_name, stamp, row_count, schema, notes)]
    append_json_lines(spark.createDataFrame(row, schemas.AUDIT_LOG).coalesce(1), audit_path)


def read_runs(spark: SparkSession, audit_path: str) -> DataFrame:
    """The trail with ``run_timestamp`` as a timestamp; empty when nothing has run yet."""
    runs = read_json_lines(spark, audit_path, schemas.AUDIT_LOG)
    return runs.withColumn("run_timestamp", F.col("run_timestamp").try_cast("timestamp"))
