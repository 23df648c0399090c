"""The newest alerts of a stream, standing ready after every micro-batch.

Alerts are dealt to keys by a hash, and each key keeps its newest rows as state, bounded
however long the stream runs. The newest rows of all keys are among them. A key whose rows
changed hands them on; the sink keeps the newest rows of every key in one small table.

The table has two halves, written in turn by the number of the batch. A reader takes the
half with the higher number, which is whole: the other half is the one being written, and
a batch that is repeated replaces its own half.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from roentra.operators import arrivals, scoring
from roentra.streaming.jobs import drain_batches

KEYS = 16
ALERT = ["filename", "pneumonia_probability", "alert_timestamp"]
ROWS = "shard int, filename string, pneumonia_probability double, alert_timestamp timestamp"
STANDING = f"batch long, {ROWS}"


def _newest(rows: pd.DataFrame, most: int) -> pd.DataFrame:
    """In the order of ``scoring.recent_alerts``: newest first, then by name, then likeliest first;
    a null time or probability last, a null name first."""
    missing = rows[ALERT].isna()
    keyed = rows.assign(n0=~missing[ALERT[0]], n1=missing[ALERT[1]], n2=missing[ALERT[2]])
    by = ["n2", ALERT[2], "n0", ALERT[0], "n1", ALERT[1]]
    ordered = keyed.sort_values(by, ascending=[True, False, True, True, True, False])
    return ordered[rows.columns].head(most)


def newest_by_key(alerts: DataFrame, most: int = 20, keys: int = KEYS) -> DataFrame:
    """(shard, alert): the ``most`` newest alerts of each key whose newest have changed; update mode."""
    shard = F.pmod(F.xxhash64(*ALERT), F.lit(keys)).cast("int")
    dealt = alerts.select(shard.alias("shard"), *ALERT)

    def keep(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        columns = ["shard", *ALERT]
        before = pd.DataFrame(columns=columns)
        if state.exists:
            names, chances, stamps = state.get
            before = pd.DataFrame(
                {"shard": key[0], ALERT[0]: names, ALERT[1]: chances, ALERT[2]: pd.to_datetime(pd.Series(stamps), unit="us")}
            )
        kept = before
        for batch in batches:
            batch = batch[columns]
            kept = _newest(batch if kept.empty else pd.concat([kept, batch], ignore_index=True), most)
        micros = kept[ALERT[2]].astype("datetime64[us]")
        state.update(
            (
                kept[ALERT[0]].tolist(),
                [None if pd.isna(v) else float(v) for v in kept[ALERT[1]]],
                [None if pd.isna(t) else int(t.value // 1000) for t in micros],
            )
        )
        yield kept

    return dealt.groupBy("shard").applyInPandasWithState(
        keep,
        ROWS,
        "names array<string>, chances array<double>, stamps array<long>",
        "update",
        GroupStateTimeout.NoTimeout,
    )


def _half(path: str, batch: int) -> str:
    return f"{path.rstrip('/')}/half={batch % 2}"


def _read_half(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(STANDING).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STANDING)


def standing(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The rows of the newest whole half (of those ``before`` a batch)."""
    halves = [_read_half(spark, _half(path, i)) for i in (0, 1)]
    numbers = [h.agg(F.max("batch")).first()[0] for h in halves]
    known = [(n, h) for n, h in zip(numbers, halves) if n is not None and (before is None or n < before)]
    if not known:
        return spark.createDataFrame([], STANDING)
    return max(known, key=lambda x: x[0])[1]


def newest_alerts(spark: SparkSession, path: str, limit: int = 20) -> DataFrame:
    """The newest alerts as they stand after the last whole batch."""
    return scoring.recent_alerts(standing(spark, path).where("shard >= 0").select(*ALERT), limit)


def run_newest(alerts: DataFrame, path: str, checkpoint: str, most: int = 20, keys: int = KEYS) -> None:
    """Drain a stream of alerts into the standing table; the next run goes on from the checkpoint."""

    def each(changed: DataFrame, number: int) -> None:
        spark = changed.sparkSession
        old = standing(spark, path, before=number).drop("batch")
        new = changed.select("shard", *ALERT)
        # At most ``keys`` times ``most`` rows. A marker row keeps the number of an empty batch.
        rows = [tuple(r) for r in new.collect()]
        shards = {r[0] for r in rows}
        rows += [tuple(r) for r in old.collect() if r["shard"] >= 0 and r["shard"] not in shards]
        marked = [(number, *r) for r in rows] + [(number, -1, None, None, None)]
        half = spark.createDataFrame(marked, STANDING).coalesce(1)
        half.write.mode("overwrite").parquet(_half(path, number))

    drain_batches(newest_by_key(alerts, most, keys), checkpoint, each, "update")


def run_topic(topic: DataFrame, path: str, checkpoint: str, most: int = 20) -> None:
    """From the messages of the alert topic to its newest alerts."""
    run_newest(arrivals.parse_alerts(topic), path, checkpoint, most)
