"""Session settings the jobs are written for; the caller owns the session itself."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Image bytes reach Python in Arrow batches: bound them by size, not by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Session with the settings above. Connector jars come from ``--packages`` at submit time."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
