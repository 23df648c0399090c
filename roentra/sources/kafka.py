"""Message topics. Needs the Kafka connector package at submit time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

FORMAT = "kafka"


# Messages of one micro-batch: bounds a backlog's first batch and what a failure repeats.
OFFSETS_PER_BATCH = 10_000_000


def topic_options(
    servers: str, topic: str, per_batch: int = OFFSETS_PER_BATCH, **extra: str
) -> dict[str, str]:
    """Options of a reader that starts at the beginning of the topic.

    A stream takes at most ``per_batch`` messages at a time; a batch read takes all. Pass
    ``minPartitions`` to read a topic of few partitions with more tasks.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": str(per_batch),
        **extra,
    }


def sink_options(servers: str, topic: str, **extra: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **extra}


def stream_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Topic as a stream: key, value, topic, partition, offset, timestamp."""
    return spark.readStream.format(FORMAT).options(**options).load()


def read_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Everything in the topic now, as a batch."""
    return spark.read.format(FORMAT).options(endingOffsets="latest", **options).load()


def publish(messages: DataFrame, options: Mapping[str, str]) -> None:
    """Publish the ``value`` column of a batch."""
    messages.select("value").write.format(FORMAT).options(**options).save()
