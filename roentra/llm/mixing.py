"""Mixing sources to target weights by temperature.

Token shares of the sources are raised to an exponent between 0 (all alike) and 1
(as they are) and normalised. The exponent is bisected: the largest whose entropy
reaches a target, or the smallest that repeats no source more than a limit. Weights
times a token budget give each source its quota, which is read in passes over the
source; every pass is a fresh permutation of blocks, and of the documents in a
block. A document's place in the quota is its place in the mixture, so that every
stretch of the mixture holds all sources in proportion to their weights.

All of it is built-in expressions. The exponent is found in rounds over the table of source
totals, each of which tries ``TRIALS`` exponents in one aggregate and brings a row for each to
the driver, however many sources there are. Running totals go through blocks, so a
source that holds a third of all tokens is spread over all its blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import takewhile

from pyspark.sql import DataFrame, Row, Window, functions as F

from roentra.operators.durable import materialize

SEED = 9
# Exponents tried in a round, and rounds: six bits of the exponent each.
TRIALS, ROUNDS = 63, 9
# Documents in a block of a permutation, and the least number of blocks.
BLOCK_ROWS, LEAST_BLOCKS = 20_000, 64
WORD = r"[^\x20\x09-\x0D]+"


def _tried(totals: DataFrame, top: float, exponents: list[float]) -> list[Row]:
    """(exponent, total, entropy, low, high) of each exponent: the sum of the raised totals, the
    entropy of the weights, and the least and greatest weight of a source for each of its tokens.

    The largest source is the unit, so that no power overflows.
    """
    trial = F.explode(F.array(*[F.lit(e) for e in exponents]))
    raised = totals.select("tokens", trial.alias("exponent")).select(
        "tokens", "exponent", F.pow(F.col("tokens") / top, F.col("exponent")).alias("r")
    )
    r, total = F.col("r"), F.sum("r")
    rate = r / F.col("tokens")
    return raised.groupBy("exponent").agg(
        total.alias("total"),
        (F.log(total) - F.sum(F.when(r > 0, r * F.log(r)).otherwise(0.0)) / total).alias("entropy"),
        (F.min(rate) / total).alias("low"),
        (F.max(rate) / total).alias("high"),
    ).orderBy("exponent").collect()


def _bisect(totals: DataFrame, top: float, keeps: Callable[[Row], bool]) -> tuple[float, float]:
    """Neighbouring exponents in 0..1: the last that ``keeps`` and the first that does not, where
    all below some exponent keep."""
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        step = (high - low) / (TRIALS + 1)
        between = [low + step * (i + 1) for i in range(TRIALS)]
        tried = _tried(totals, top, sorted(set(between)))
        kept = list(takewhile(keeps, tried))
        after = tried[len(kept)]["exponent"] if len(kept) < len(tried) else high
        low, high = (kept[-1]["exponent"] if kept else low), after
    return low, high


def source_weights(
    sizes: DataFrame,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget: float | None = None,
) -> DataFrame:
    """(source, tokens, weight, exponent, passes, quota) of each source with tokens.

    ``sizes`` has the columns source and tokens. Exactly one target is given:
    ``target_entropy`` as a share of the entropy of equal weights (the exponent is
    the largest that reaches it; 1 if the shares do so as they are), or
    ``max_repeats``, passes over any source (the smallest exponent that keeps to it;
    1 if none does). Without a budget in tokens every source is read at least once.
    """
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give target_entropy or max_repeats")
    totals = materialize(
        sizes.groupBy("source").agg(F.sum("tokens").alias("tokens")).where("tokens > 0"), "mix-totals"
    )
    top, n = totals.agg(F.max("tokens").cast("double"), F.count(F.lit(1))).first()
    if not n:
        none = [F.lit(None).cast(t).alias(c) for c, t in (("weight", "double"), ("exponent", "double"), ("passes", "double"), ("quota", "long"))]
        return totals.select("source", "tokens", *none)

    def spent(t: Row) -> float:
        """Tokens to read: without a budget enough to read every source once or more."""
        return float(budget) if budget else 1.0 / t["low"]

    if target_entropy is not None:
        goal = math.log(n) * target_entropy
        enough = lambda t: t["entropy"] >= goal
        (whole,) = _tried(totals, top, [1.0])
        exponent = 1.0 if enough(whole) else _bisect(totals, top, enough)[0]
    else:
        too_often = lambda t: t["high"] * spent(t) > max_repeats
        (none,) = _tried(totals, top, [0.0])
        exponent = _bisect(totals, top, too_often)[1] if too_often(none) else 0.0
    (chosen,) = _tried(totals, top, [exponent])
    weight = F.pow(F.col("tokens") / top, F.lit(exponent)) / F.lit(chosen["total"])
    # Whole tokens, so that rounding errors never begin another pass.
    quota = F.round(F.col("weight") * F.lit(spent(chosen))).cast("long")
    return totals.select(
        "source", F.col("tokens").cast("long").alias("tokens"), weight.alias("weight"), F.lit(exponent).alias("exponent")
    ).select(
        "source", "tokens", "weight", "exponent",
        (quota / F.col("tokens")).alias("passes"), quota.alias("quota"),
    )


def mixture(
    df: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget: float | None = None,
) -> DataFrame:
    """(id, source, n_tokens, weight, exponent, pass, position): one row for each time that a
    document is read, in the order of ``position`` (0 to 1, ties by id).

    Tokens are words. A document is read in a pass if its first token is inside
    the quota, so a source exceeds its quota by less than a document. Documents
    without tokens (null texts too) cost nothing: once in pass 0, position 0,
    weight null. A null source is a source like any other, as are null ids; repeated
    rows are documents of their own. Other columns are not read.
    """
    words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    # Null is told from any name by a mark before the name.
    source = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null"))
    rows = materialize(
        df.select(F.col(id_col).alias("id"), source.alias("source"), words.alias("tokens")), "mix-rows"
    )
    weights = materialize(
        source_weights(rows, target_entropy, max_repeats, budget), "mix-weights"
    )
    blocks = max(LEAST_BLOCKS, rows.count() // BLOCK_ROWS)
    place = F.xxhash64(F.lit(SEED), "id", "tokens")
    placed = rows.where("tokens > 0").select(
        "*", F.pmod(place, F.lit(blocks)).alias("block"), place.alias("place")
    )
    inside = Window.partitionBy("source", "block").orderBy("place", "id")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    # One row a block and pass: where the block begins in the permutation of that pass.
    totals = placed.groupBy("source", "block").agg(F.sum("tokens").alias("total"))
    known = weights.where("quota > 0").select(F.col("source").alias("own"), "tokens", "passes", "weight", "exponent", "quota")
    turns = totals.join(known, F.col("source") == F.col("own")).select(
        "source", "block", "total", "tokens", "weight", "exponent", "quota",
        F.explode(F.sequence(F.lit(0), F.ceil("passes").cast("int") - 1)).alias("pass"),
    )
    shuffled = Window.partitionBy("source", "pass").orderBy(
        F.xxhash64(F.lit(SEED + 1), "block", "pass"), "block"
    )
    earlier = F.sum("total").over(shuffled.rowsBetween(Window.unboundedPreceding, -1))
    begins = turns.select(
        F.col("source").alias("own"), F.col("block").alias("own_block"),
        "pass", "weight", "exponent", "quota",
        (F.col("pass") * F.col("tokens") + F.coalesce(earlier, F.lit(0))).alias("begin"),
    )
    # A pass whose blocks begin beyond the quota is not read; one row keeps the passes of a block.
    passes = (
        begins.where("begin < quota")
        .groupBy("own", "own_block")
        .agg(F.collect_list(F.struct("pass", "weight", "exponent", "quota", "begin")).alias("turns"))
    )
    ranked = placed.withColumn("before", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    same = (F.col("source") == F.col("own")) & (F.col("block") == F.col("own_block"))
    read = ranked.join(passes, same).select(
        "id", "source", "tokens", "before", F.inline("turns")
    )
    first = F.col("begin") + F.col("before")
    name = F.when(F.col("source") != "null", F.substring("source", 2, 1 << 30)).alias(source_col)
    timed = read.where(first < F.col("quota")).select(
        F.col("id").alias(id_col), name, F.col("tokens").alias("n_tokens"),
        "weight", "exponent", "pass", (first / F.col("quota")).alias("position"),
    )
    free = rows.where("tokens = 0").select(
        F.col("id").alias(id_col), name, F.col("tokens").alias("n_tokens"),
        F.lit(None).cast("double").alias("weight"), F.lit(None).cast("double").alias("exponent"),
        F.lit(0).alias("pass"), F.lit(0.0).alias("position"),
    )
    return timed.union(free)
