"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F

# At most this many keys are reported: the bound of what reaches the driver and is broadcast.
MAX_HOT_KEYS = 16_384
ROWS_PER_SALT = 1_000_000
# Sampled rows that stand for ROWS_PER_SALT rows; enough that no key of twice that size is missed.
SAMPLED_PER_SALT = 1_000


def hot_keys(df: DataFrame, key: str, rows_per_salt: int = ROWS_PER_SALT) -> list[Row]:
    """(hot_key, salts): keys with more than about ``rows_per_salt`` rows, and into how many
    parts of that size to cut them. At most ``MAX_HOT_KEYS``, largest first.

    Counts a sample of the key column (all of it when ``rows_per_salt`` is
    small). The estimate decides only how rows are spread over tasks; joins
    that use it read every row and are exact whatever it says. They need one
    fixed answer, so this runs a job instead of returning a plan that each use
    would evaluate anew.
    """
    fraction = min(1.0, SAMPLED_PER_SALT / rows_per_salt)
    keys = df.where(F.col(key).isNotNull()).select(F.col(key).alias("hot_key"))
    looked_at = keys if fraction == 1.0 else keys.sample(fraction, seed=0)
    estimate = F.col("seen") / fraction
    found = (
        looked_at.groupBy("hot_key")
        .agg(F.count(F.lit(1)).alias("seen"))
        .where(estimate > rows_per_salt)
        .orderBy(F.desc("seen"), "hot_key")
        .limit(MAX_HOT_KEYS)
        .select("hot_key", F.ceil(estimate / rows_per_salt).cast("int").alias("salts"))
    )
    return found.collect()


def _hot_frame(df: DataFrame, key: str, hot: list[Row]) -> DataFrame:
    """The hot keys as a local relation (_hot_key, _salts), marked for broadcast."""
    columns = {"_hot_key": [r["hot_key"] for r in hot], "_salts": [r["salts"] for r in hot]}
    frame = df.sparkSession.createDataFrame(pa.table(columns))
    return F.broadcast(
        frame.select(F.col("_hot_key").cast(df.schema[key].dataType), F.col("_salts").cast("int"))
    )


def hot_split_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    rows_per_salt: int = ROWS_PER_SALT,
    hot: list[Row] | None = None,
) -> DataFrame:
    """Inner equi-join for a left side with repeated, possibly hot keys and a narrow right side
    of unique keys. Both key columns are kept.

    Without hot keys this is a plain join. Otherwise the right rows of hot keys
    (one per key, so at most ``MAX_HOT_KEYS``) are broadcast: left rows of hot
    keys join where they are, without shuffle or sort. The remaining left rows,
    none of whose keys is hot, join as usual. ``hot`` (from ``hot_keys``) is looked
    up here unless it is given; an empty list leaves skew to adaptive execution.
    """
    on_keys = F.col(left_key) == F.col(right_key)
    if hot is None:
        hot = hot_keys(left, left_key, rows_per_salt)
    if not hot:
        return left.join(right, on_keys, "inner")
    frame = _hot_frame(left, left_key, hot)
    hot_right = right.join(frame, F.col(right_key) == F.col("_hot_key"), "left_semi")
    in_place = left.join(F.broadcast(hot_right), on_keys, "inner")
    others = left.join(frame, F.col(left_key) == F.col("_hot_key"), "left_anti")
    return in_place.unionByName(others.join(right, on_keys, "inner"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    rows_per_salt: int = ROWS_PER_SALT,
    hot: list[Row] | None = None,
) -> DataFrame:
    """Like ``hot_split_join``, for a right side too wide to broadcast even a few rows of.

    Left rows of a hot key are spread over its salts by a hash of the row
    (stable under task retries, unlike a random salt); only the matching right
    row is copied to each salt. Rows equal in all columns, which no hash parts,
    go through the join as one row with a count. All other rows join as usual. Pass ``hot`` (from
    ``hot_keys``) when the hot keys can be read off a source that is cheaper to
    scan than ``left``.
    """
    if hot is None:
        hot = hot_keys(left, left_key, rows_per_salt)
    if not hot:
        return left.join(right, F.col(left_key) == F.col(right_key), "inner")
    frame = _hot_frame(left, left_key, hot)

    on_keys = F.col(left_key) == F.col(right_key)
    others = left.join(frame, F.col(left_key) == F.col("_hot_key"), "left_anti")
    columns = [F.col(f"`{c}`") for c in left.columns]
    salted_left = (
        left.join(frame, F.col(left_key) == F.col("_hot_key"))
        .groupBy(*columns, "_salts")
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_salt", F.pmod(F.xxhash64(*columns), F.col("_salts")).cast("int"))
        .drop("_salts")
    )
    salted_right = (
        right.join(frame, F.col(right_key) == F.col("_hot_key"))
        .withColumn("_right_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
        .drop("_hot_key", "_salts")
    )
    met = salted_left.join(salted_right, on_keys & (F.col("_salt") == F.col("_right_salt")))
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))
    spread = met.withColumn("_copy", copy).drop("_copy", "_copies", "_salt", "_right_salt")
    return others.join(right, on_keys).unionByName(spread)
