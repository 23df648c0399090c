"""File-arrival events and the image manifest, in batch or streaming frames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roentra.functions import identity, messages, times


def arrival_events(files: DataFrame, published_at: Column | None = None) -> DataFrame:
    """One JSON message per file (``path``): patient_id, file_path, ingestion_timestamp."""
    clock = times.epoch_seconds_now() if published_at is None else published_at
    return files.select(
        messages.to_message(
            identity.image_key(F.col("path")).alias("patient_id"),
            F.col("path").alias("file_path"),
            clock.alias("ingestion_timestamp"),
        ).alias("value")
    )


def parsed_messages(topic: DataFrame) -> DataFrame:
    """Add ``text`` and ``event`` (NULL unless the payload is one JSON object) to a topic frame.

    The event comes out of a generator, because a plain column would be parsed
    again by every filter and field access on it.
    """
    event = messages.json_object(F.col("text"))
    with_text = topic.withColumn("text", messages.payload_text(F.col("value")))
    return with_text.select("*", F.explode(F.array(event)).alias("event"))


def is_valid_arrival(event: Column) -> Column:
    """The object has a patient_id key; its value may be null."""
    return F.coalesce(F.map_contains_key(event, "patient_id"), F.lit(False))


def arrival_manifest(topic: DataFrame, consumed_at: Column | None = None) -> DataFrame:
    """Valid messages as manifest rows. Missing fields are NULL. Offsets repeat across
    partitions, so ``kafka_partition`` is carried where the source has it."""
    event = F.col("event")
    columns = [
        event["patient_id"].alias("patient_id"),
        event["file_path"].alias("file_path"),
        event["ingestion_timestamp"].try_cast("double").alias("ingestion_timestamp"),
        F.col("offset").cast("bigint").alias("kafka_offset"),
    ]
    if "partition" in topic.columns:
        columns.append(F.col("partition").alias("kafka_partition"))
    if consumed_at is not None:
        columns.append(consumed_at.alias("consumed_at"))
    return parsed_messages(topic).where(is_valid_arrival(event)).select(*columns)


def arrival_bodies(topic: DataFrame, consumed_at: Column | None = None) -> DataFrame:
    """The rows of ``arrival_manifest`` with the whole message as ``body``, a VARIANT.

    Fields that no schema names are kept and read by their path (``body_fields``). A message
    that repeats a key has no body.
    """
    texts = parsed_messages(topic).withColumn("body", messages.body(F.col("text")))
    valid = texts.where(is_valid_arrival(F.col("event")))

    def field(name: str, kind: str) -> Column:
        return F.try_variant_get("body", f"$.{name}", kind)

    known = [
        F.coalesce(field("patient_id", "string"), F.col("event")["patient_id"]).alias("patient_id"),
        F.coalesce(field("file_path", "string"), F.col("event")["file_path"]).alias("file_path"),
        F.coalesce(
            field("ingestion_timestamp", "double"),
            F.col("event")["ingestion_timestamp"].try_cast("double"),
        ).alias("ingestion_timestamp"),
        F.col("offset").cast("bigint").alias("kafka_offset"),
    ]
    if "partition" in topic.columns:
        known.append(F.col("partition").alias("kafka_partition"))
    if consumed_at is not None:
        known.append(consumed_at.alias("consumed_at"))
    return valid.select(*known, "body")


def body_fields(bodies: DataFrame, **fields: tuple[str, str]) -> DataFrame:
    """Add columns by name from (path, type) in the body; NULL where the message has no such field or
    one of another kind."""
    found = {n: F.try_variant_get("body", path, kind) for n, (path, kind) in fields.items()}
    return bodies.withColumns(found)


def body_shapes(bodies: DataFrame) -> DataFrame:
    """How many messages have which fields and types: what senders have added or changed."""
    shape = F.schema_of_variant("body").alias("shape")
    return bodies.groupBy(shape).agg(F.count(F.lit(1)).alias("n"))


def reject_reason(text: Column, event: Column) -> Column:
    """not_json, not_object or no_patient_id; NULL for a valid message."""
    looks_like_object = F.startswith(F.ltrim(text), F.lit("{"))
    whole_value = messages.is_json_value(text) & ~looks_like_object
    return (
        F.when(event.isNull() & F.coalesce(whole_value, F.lit(False)), "not_object")
        .when(event.isNull(), "not_json")
        .when(~is_valid_arrival(event), "no_patient_id")
    )


def rejected_messages(topic: DataFrame) -> DataFrame:
    """Invalid messages with the reason, for a quarantine table."""
    reason = reject_reason(F.col("text"), F.col("event"))
    judged = parsed_messages(topic).select("*", F.explode(F.array(reason)).alias("reason"))
    return judged.where(F.col("reason").isNotNull()).drop("text", "event")


def reject_counts(topic: DataFrame) -> DataFrame:
    return rejected_messages(topic).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def parse_alerts(topic: DataFrame) -> DataFrame:
    """Alert messages as rows; payloads that are not one JSON object are skipped."""
    event = F.col("event")
    return (
        parsed_messages(topic)
        .where(event.isNotNull())
        .select(
            event["filename"].alias("filename"),
            event["pneumonia_probability"].try_cast("double").alias("pneumonia_probability"),
            event["alert_timestamp"].try_cast("timestamp").alias("alert_timestamp"),
        )
    )
