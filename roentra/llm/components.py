"""Connected components of a link table, by rounds of Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roentra.operators.durable import materialize


def _large_star(links: DataFrame) -> DataFrame:
    """Each node hangs its larger neighbours on the smallest node it sees."""
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("low"))
    low = F.least("low", "u").alias("v")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), low).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node hangs itself and its smaller neighbours on the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("low"))
    hung = links.join(least, "u").where("v > low").select(F.col("v").alias("u"), "low")
    return hung.union(least).select("u", F.col("low").alias("v")).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each linked node that is not itself one.

    ``links`` has the columns u and v, in any order and with repeats. Alternates
    large and small stars until nothing changes; every round is written to the
    shared folder, so a lost executor costs one round. An empty table gives none.
    """
    ordered = links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    now = materialize(ordered.distinct(), "components")
    before, state = None, _state(now)
    while state[0] and state != before:
        now = materialize(_small_star(_large_star(now)), "components")
        before, state = state, _state(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
