"""Deterministic patient-level train / val / test split with exact quotas.

Patients are ordered by a seeded SHA-256 of their id. A patient's split depends
only on whether its key lies below the key at rank ``train_end`` or ``val_end``,
so just these two boundary keys have to be found exactly:

1. count patients per 4-digit hash prefix (65,536 groups at most, combined map-side);
2. running totals over that bounded table name the prefixes holding the two ranks;
3. only the patients of those prefixes are ranked.

No global sort, no id reaches the driver, and the patients keep the
partitioning they arrived with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roentra import schemas

PREFIX_DIGITS = 4


def order_key(id_col: Column, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), id_col), 256)


def _quota(total: Column, share: float) -> Column:
    # Double arithmetic and truncation; a decimal literal would round 0.7 * 90 up to 63.
    return F.floor(total * F.lit(float(share)))


def split_boundaries(
    keyed: DataFrame,
    train_share: float,
    val_share: float,
    prefix_digits: int = PREFIX_DIGITS,
) -> DataFrame:
    """One row (train_until, val_until): the first key past the train and past the val quota."""
    # Declared non-null, so that the join below infers no extra filter: with the
    # same plan underneath, all uses of the patients share one shuffle.
    prefix = F.coalesce(F.substring("_key", 1, prefix_digits), F.lit(""))
    with_prefix = keyed.select("_key", prefix.alias("_prefix"))
    counts = with_prefix.groupBy("_prefix").agg(F.count(F.lit(1)).alias("_in_prefix"))

    # At most 16^prefix_digits rows, so this ordered window is a bounded single task.
    running = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    whole = running.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = counts.select(
        "_prefix",
        (F.sum("_in_prefix").over(running) - F.col("_in_prefix")).alias("_before"),
        F.sum("_in_prefix").over(running).alias("_through"),
        F.sum("_in_prefix").over(whole).alias("_total"),
    )
    train_end = _quota(F.col("_total"), train_share)
    val_end = train_end + _quota(F.col("_total"), val_share)

    def holds(rank: str) -> Column:
        return (F.col("_before") <= F.col(rank)) & (F.col(rank) < F.col("_through"))

    edges = (
        placed.withColumn("_train_end", train_end)
        .withColumn("_val_end", val_end)
        .where(holds("_train_end") | holds("_val_end"))
        .select("_prefix", "_before", "_train_end", "_val_end")
    )  # two rows at most

    in_prefix = Window.partitionBy("_prefix").orderBy("_key")
    rank = F.col("_before") + F.row_number().over(in_prefix)
    ranked = with_prefix.join(F.broadcast(edges), "_prefix").withColumn("_rank", rank)
    return ranked.agg(
        F.min(F.when(F.col("_rank") > F.col("_train_end"), F.col("_key"))).alias("train_until"),
        F.min(F.when(F.col("_rank") > F.col("_val_end"), F.col("_key"))).alias("val_until"),
    )


def assign_patient_splits(
    patients: DataFrame,
    id_col: str = "patient_id",
    seed: int = schemas.SPLIT_SEED,
    train_share: float = schemas.TRAIN_SHARE,
    val_share: float = schemas.VAL_SHARE,
    prefix_digits: int = PREFIX_DIGITS,
) -> DataFrame:
    """Add ``split`` to a frame with one row per patient. NULL ids are dropped."""
    keyed = patients.where(F.col(id_col).isNotNull()).withColumn(
        "_key", order_key(F.col(id_col), seed)
    )
    bounds = split_boundaries(keyed, train_share, val_share, prefix_digits)
    limits = bounds.select(F.struct("train_until", "val_until")).scalar()

    def below(limit: str) -> Column:
        # No key at the quota's end: the quota takes everybody that is left.
        return F.coalesce(F.col("_key") < limits[limit], F.lit(True))

    split = F.when(below("train_until"), "train").when(below("val_until"), "val").otherwise("test")
    return keyed.withColumn("split", split).drop("_key")


def split_counts(patients: DataFrame, model_ready: DataFrame) -> DataFrame:
    """Patients and gold rows per split. Quotas hold for patients, so row shares are only close."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    both = patients.select("split", one.alias("p"), zero.alias("r")).unionByName(
        model_ready.select("split", zero.alias("p"), one.alias("r"))
    )
    return both.groupBy("split").agg(
        F.sum("p").alias("n_patients"), F.sum("r").alias("n_rows")
    )
