"""Running a stream until its source is drained."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

# A query keeps its last 100 reports; micro-batches are bounded but never that short.
POLL_SECONDS = 1
# Rows that a stateful operator left out because they came after the watermark.
LATE = "late"


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, object]) -> Iterator[None]:
    """Session settings for as long as a stream runs; those before are put back."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def drain(
    stream: DataFrame, checkpoint: str, fmt: str, options: Mapping[str, str]
) -> dict[str, int]:
    """Process everything available, then stop. Returns the observed counts, as ``name.field``.

    The checkpoint remembers the position, so the next run continues there.
    """
    writer = stream.writeStream.format(fmt).outputMode("append").options(**options)
    return _run(writer, checkpoint)


def drain_batches(
    stream: DataFrame,
    checkpoint: str,
    each: Callable[[DataFrame, int], None],
    mode: str = "append",
) -> dict[str, int]:
    """Like ``drain``, handing every micro-batch with its number to ``each``.

    A batch that fails is handed over again with the same number, so ``each`` has to
    replace what it wrote under that number.
    """
    return _run(stream.writeStream.outputMode(mode).foreachBatch(each), checkpoint)


def _run(writer: DataStreamWriter, checkpoint: str) -> dict[str, int]:
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return _finish(writer.start())


def _finish(query: StreamingQuery) -> dict[str, int]:
    batches: dict[int, dict[str, int]] = {}
    finished = False
    while not finished:
        finished = query.awaitTermination(POLL_SECONDS)
        # Only the latest progress reports are kept by the query, so read them as it runs.
        for progress in query.recentProgress:
            counts = {
                f"{name}.{field}": count or 0
                for name, row in progress.observedMetrics.items()
                for field, count in row.asDict().items()
            }
            counts[LATE] = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
            batches[progress.batchId] = counts
    totals: dict[str, int] = {}
    for counts in batches.values():
        for key, count in counts.items():
            totals[key] = totals.get(key, 0) + count
    return totals
