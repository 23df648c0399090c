"""Score -> flag -> publish, one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from roentra.functions import messages, times
from roentra.operators import scoring
from roentra.streaming.jobs import drain


def flagged_alerts(scored: DataFrame, timestamp: Column | None = None) -> DataFrame:
    """Alert rows of a batch or streaming frame of scored rows."""
    return scoring.clinical_alerts(scoring.predictions(scored), timestamp)


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Alerts as JSON ``value`` rows for a message topic; times as ISO text with microseconds."""
    stamp = F.col("alert_timestamp")
    if not isinstance(alerts.schema["alert_timestamp"].dataType, StringType):
        stamp = times.iso_utc(stamp).alias("alert_timestamp")
    value = messages.to_message(F.col("filename"), F.col("pneumonia_probability"), stamp)
    return alerts.select(value.alias("value"))


def run_alerts(
    scored: DataFrame,
    checkpoint: str,
    fmt: str,
    options: Mapping[str, str],
    as_messages: bool = False,
    timestamp: Column | None = None,
) -> dict[str, int]:
    """Publish an alert for every flagged row of a stream of scored rows.

    A failing sink fails the batch and the batch is retried on restart, so no
    alert is dropped. Returns how many rows were seen and how many published.
    """
    watched = scored.observe("scored", F.count(F.lit(1)).alias("seen"))
    alerts = flagged_alerts(watched, timestamp).observe(
        "alerts", F.count(F.lit(1)).alias("written")
    )
    counts = drain(alert_messages(alerts) if as_messages else alerts, checkpoint, fmt, options)
    return {"seen": counts.get("scored.seen", 0), "written": counts.get("alerts.written", 0)}
