"""Clock expressions. Jobs take the clock as a column so tests can pin it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def utc_now() -> Column:
    """Current UTC wall clock as a zone-free timestamp, whatever the session zone."""
    local = F.current_timestamp().cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with microseconds and an explicit ``+00:00``."""
    return F.concat(
        F.date_format(ts.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")
    )


def epoch_seconds_now() -> Column:
    """Epoch seconds with microseconds, exact (a double would print in exponent form in JSON)."""
    return (F.unix_micros(F.current_timestamp()).cast("decimal(20,0)") / 1_000_000).cast(
        "decimal(18,6)"
    )


def minute_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")
