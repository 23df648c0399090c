"""What each task finds, merged in a tree: for partial results that no built-in aggregate has."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

# Payloads that meet in one task.
ARITY = 64
SCHEMA = "part long, payload binary"


def _row(part: int, payload: object) -> pa.Table:
    columns = [pa.array([part], pa.int64()), pa.array([pickle.dumps(payload)], pa.binary())]
    return pa.Table.from_arrays(columns, names=["part", "payload"])


def count_tasks(df: DataFrame) -> int:
    """About how many tasks a scan of ``df`` or of a part of its files has."""
    last = df.select(F.spark_partition_id().alias("part")).agg(F.max("part")).first()[0]
    return 1 + (last or 0)


def combine(
    df: DataFrame,
    tasks: int,
    make: Callable[[pa.RecordBatch], object],
    merge: Callable[[object, object], object],
) -> object | None:
    """``make`` of every Arrow batch, merged in its task and then ``ARITY`` at a time; None without rows.

    Payloads are merged in the order of their partitions, so equal partitions give equal
    results to the last bit. Only the last payload comes to the driver.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        payload = None
        for batch in batches:
            if batch.num_rows:
                found = make(batch)
                payload = found if payload is None else merge(payload, found)
        if payload is not None:
            yield _row(TaskContext.get().partitionId(), payload).to_batches()[0]

    def join(rows: pa.Table) -> pa.Table:
        parts = sorted(zip(rows["part"].to_pylist(), rows["payload"].to_pylist()))
        merged = pickle.loads(parts[0][1])
        for _, payload in parts[1:]:
            merged = merge(merged, pickle.loads(payload))
        return _row(parts[0][0] // ARITY, merged)

    found = df.mapInArrow(task, SCHEMA)
    last = tasks - 1
    while last > 0:
        found = found.groupBy(F.floor(F.col("part") / ARITY)).applyInArrow(join, SCHEMA)
        last //= ARITY
    # One row, or a few if a scan had more tasks than were counted.
    merged = None
    for row in sorted(found.collect(), key=lambda r: r["part"]):
        payload = pickle.loads(row["payload"])
        merged = payload if merged is None else merge(merged, payload)
    return merged
