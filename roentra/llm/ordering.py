"""Rows in key order without one ordered partition: neighbours, and running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Rows of one ordered bucket, and the most buckets there are (what is broadcast has a row for each).
BUCKET_ROWS = 128
MOST_BUCKETS = 1 << 20
CUTS = 256
# Bytes of text in one partition: callers turn texts into rows many times their size.
PARTITION_BYTES = 3_000_000


def range_bucket(df: DataFrame, key: str, value: str) -> tuple[Column, int]:
    """(bucket, bytes): a number from 0 that does not fall as ``key`` (whole numbers) grows, null
    for null keys; and the size of all values.

    Quantiles of the key (at most ``CUTS``, the only thing collected) give coarse
    ranges, and each is cut evenly, so that dense and sparse ranges get alike buckets.
    """
    quantiles = F.percentile_approx(key, [i / CUTS for i in range(1, CUTS)], 10 * CUTS)
    rows, low, high, cuts, size = df.agg(
        F.count(key), F.min(key), F.max(key), quantiles, F.sum(F.octet_length(value))
    ).first()
    if not rows:
        return F.lit(None).cast("long"), size or 0
    edges = sorted({low, high + 1, *cuts})
    fine = min(MOST_BUCKETS, -(-rows // BUCKET_ROWS)) // (len(edges) - 1) + 1
    bounds = F.array(*[F.lit(int(e)).cast("long") for e in edges])
    column = F.col(key).cast("long")
    coarse = F.size(F.filter(bounds, lambda e: e <= column))
    begin, end = F.element_at(bounds, coarse), F.element_at(bounds, coarse + 1)
    share = (column - begin).cast("double") / (end - begin).cast("double")
    within = F.least(F.floor(share * fine), F.lit(fine - 1))
    return F.when(column.isNotNull(), (coarse - 1) * fine + within).cast("long"), size or 0


def with_next(df: DataFrame, key: str, value: str) -> DataFrame:
    """(bucket, row, key, value, next_value, extra): each row with the value of the next row in
    descending key order, and after the last the first.

    Null keys come last; rows with equal keys follow each other by content. The
    table is shuffled once, by range of the key. The first row of each bucket
    (of at most ``MOST_BUCKETS``) is also sent to the bucket before it, where it
    follows all others and is marked ``extra``.
    """
    bucket, size = range_bucket(df, key, value)
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Null keys are below all others and form the last bucket.
    placed = df.select(
        F.coalesce(bucket, F.lit(-1)).alias("bucket"), F.col(key).alias("key"), F.col(value).alias("value")
    )
    heads = placed.groupBy("bucket").agg(F.max("key").alias("head"))
    down = Window.orderBy(F.desc("bucket"))
    first = F.max("bucket").over(Window.partitionBy())
    before = F.lag("bucket").over(down)
    last = F.min("bucket").over(Window.partitionBy())
    # The bucket whose last row is followed by this head; the very first follows the very last.
    heads = heads.select(
        F.col("bucket").alias("own"),
        "head",
        F.when(F.col("bucket") == first, last).otherwise(before).alias("before"),
    )
    tagged = placed.join(F.broadcast(heads), F.col("bucket") == F.col("own"))
    places = F.when(
        F.col("key").eqNullSafe(F.col("head")),
        F.array(
            F.struct(F.col("bucket").alias("at"), F.lit(False).alias("extra")),
            F.struct(F.col("before").alias("at"), F.lit(True).alias("extra")),
        ),
    ).otherwise(F.array(F.struct(F.col("bucket").alias("at"), F.lit(False).alias("extra"))))
    sent = tagged.select("key", "value", F.explode(places).alias("place")).select(
        F.col("place.at").alias("bucket"), "place.extra", "key", "value"
    )
    sent = sent.repartition(max(least, size // PARTITION_BYTES), "bucket")
    order = Window.partitionBy("bucket").orderBy(
        "extra", F.desc_nulls_last("key"), F.xxhash64("value"), "value"
    )
    return sent.select(
        "bucket",
        F.row_number().over(order).cast("long").alias("row"),
        "key",
        "value",
        F.lead("value").over(order).alias("next_value"),
        "extra",
    )


def running(df: DataFrame, groups: list[str], bucket: str, order: list, value: Column) -> DataFrame:
    """``df`` with ``before``, the sum of ``value`` over the earlier rows of its group.

    Rows are ordered by bucket, then by ``order``. Only totals per bucket pass
    through a window over a whole group; rows are ranked inside their bucket, so a
    group that holds a third of the table is spread over all its buckets.
    """
    key = [*groups, bucket]
    totals = df.groupBy(*key).agg(F.sum(value).alias("total"))
    earlier = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *key, F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = df.withColumn("inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = own.join(offsets, key)
    return joined.withColumn("before", F.col("offset") + F.col("inside")).drop("offset", "inside")
