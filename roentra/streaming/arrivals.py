"""Arrival events out, image manifest in, as Structured Streaming jobs.

The checkpoint replaces the consumer group: a restarted job continues after the
last finished batch, and the file sink commits each batch once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from roentra.operators import arrivals
from roentra.sources.files import listing_parts
from roentra.streaming.jobs import LATE, drain, settings

# How many tasks look up the files of a micro-batch: 10,000 unless set, whatever the files and cores.
LOOKUP_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
# Names of files seen before are kept on the disks of the executors, in as many parts as a listing has.
STATE = "spark.sql.streaming.stateStore"
STATE_STORE = {
    f"{STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STATE}.rocksdb.boundedMemoryUsage": "true",
}
# What tells one message of a topic from all others, where the source has it.
POSITION = ("topic", "partition", "offset")


@dataclass(frozen=True)
class Replays:
    """How long a message may be sent again: messages are remembered by ``identity`` until the newest
    ``event_time`` is ``delay`` ahead of theirs."""

    event_time: str = "timestamp"
    delay: str = "1 day"
    identity: Sequence[str] = POSITION


def without_replays(topic: DataFrame, replays: Replays) -> DataFrame:
    """Each message once, in the batch that has it first. Messages older than the delay are not
    remembered any more and are left out, as late; the stream counts them."""
    own = [c for c in replays.identity if c in topic.columns]
    if not own:
        raise ValueError(f"the topic has none of the columns {', '.join(replays.identity)}")
    bounded = topic.withWatermark(replays.event_time, replays.delay)
    return bounded.dropDuplicatesWithinWatermark(own)


def run_manifest(
    topic: DataFrame,
    manifest_path: str,
    checkpoint: str,
    fmt: str = "json",
    consumed_at: Column | None = None,
    replays: Replays | None = None,
) -> dict[str, int]:
    """Drain the topic, append valid messages to the manifest.

    Returns how many messages were seen and how many written. With ``replays``, messages
    that a producer or a reset consumer repeats are written once, across micro-batches and
    restarts; ``late`` messages came after the delay, and are neither written nor known to
    be repeated.
    """
    watched = topic.observe("topic", F.count(F.lit(1)).alias("seen"))
    once = watched if replays is None else without_replays(watched, replays)
    manifest = arrivals.arrival_manifest(once, consumed_at).observe(
        "manifest", F.count(F.lit(1)).alias("written")
    )
    counts = drain(manifest, checkpoint, fmt, {"path": manifest_path})
    found = {"seen": counts.get("topic.seen", 0), "written": counts.get("manifest.written", 0)}
    return found if replays is None else found | {"late": counts.get(LATE, 0)}


def run_publisher(
    files: DataFrame,
    checkpoint: str,
    fmt: str,
    options: Mapping[str, str],
    published_at: Column | None = None,
) -> int:
    """Publish one arrival event per new file of a streaming frame (path); returns their number."""
    events = arrivals.arrival_events(files, published_at).observe(
        "events", F.count(F.lit(1)).alias("published")
    )
    spark = files.sparkSession
    parts = listing_parts(spark)
    with settings(spark, {**STATE_STORE, LOOKUP_TASKS: parts, "spark.sql.shuffle.partitions": parts}):
        return drain(events, checkpoint, fmt, options).get("events.published", 0)
