"""Tables behind the three dashboard tabs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roentra.functions import scores, times


def ops_metrics(audit: DataFrame) -> DataFrame:
    """One row: number of runs, of jobs, and the latest run to the minute."""
    return audit.agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_distinct("job_name").alias("unique_jobs"),
        times.minute_label(F.max("run_timestamp")).alias("latest_run"),
    )


def run_history(audit: DataFrame, limit: int | None = None) -> DataFrame:
    """All runs, newest first; ``limit`` bounds what a page shows.

    The row number as last sort key lets the range partitioner split a large
    group of identical rows over several tasks.
    """
    runs = audit.select("job_name", "run_timestamp", "row_count", "notes")
    newest = (
        runs.withColumn("_row", F.monotonically_increasing_id())
        .orderBy(F.desc("run_timestamp"), "job_name", "row_count", "notes", "_row")
        .drop("_row")
    )
    return newest if limit is None else newest.limit(limit)


def case_volumes(case_counts: DataFrame) -> DataFrame:
    """Chart rows of the case counts: one per table row, label decoded, not summed."""
    return case_counts.select(
        "view_position", scores.class_name(F.col("label") == 1).alias("diagnosis"), "case_count"
    )


def demographics_preview(demographics: DataFrame, limit: int = 20) -> DataFrame:
    """First rows of the demographics table in key order."""
    return demographics.orderBy(
        F.asc_nulls_first("patient_sex"),
        F.asc_nulls_first("patient_age_bucket"),
        F.asc_nulls_first("label"),
    ).limit(limit)
