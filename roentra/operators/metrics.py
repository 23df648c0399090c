"""Evaluation of scored rows (label, probability) as aggregations.

One policy for all metrics: they are over the rows that have a label 0 or 1 and a
score that is a number. ``score_quality`` counts the rows that are left out.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from roentra import schemas
from roentra.functions import scores

MIN_RANGES, MAX_RANGES = 1_024, 16_384


def _is_number(column: Column) -> Column:
    return column.isNotNull() & ~F.isnan(column.cast("double"))


def _usable(label_col: str, score_col: str) -> Column:
    return F.coalesce(F.col(label_col).isin(0, 1), F.lit(False)) & _is_number(F.col(score_col))


def score_quality(
    scored: DataFrame, label_col: str = "label", score_col: str = "probability"
) -> DataFrame:
    """Rows by why they count or not: total, usable, without a score, without a label."""
    has_score = _is_number(F.col(score_col))
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(_usable(label_col, score_col)).alias("n_usable"),
        F.count_if(~has_score).alias("n_without_score"),
        F.count_if(~F.coalesce(F.col(label_col).isin(0, 1), F.lit(False))).alias("n_without_label"),
    )


def _counts(scored: DataFrame, threshold: float, label_col: str, score_col: str) -> DataFrame:
    actual = F.col(label_col) == 1
    predicted = scores.is_positive(F.col(score_col), threshold)
    return scored.where(_usable(label_col, score_col)).agg(
        F.count_if(~actual & ~predicted).alias("tn"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(actual & predicted).alias("tp"),
    )


def confusion_matrix(
    scored: DataFrame,
    threshold: float = schemas.DECISION_THRESHOLD,
    label_col: str = "label",
    score_col: str = "probability",
) -> DataFrame:
    """Two rows, actual 0 and 1; columns count the predicted classes."""
    cells = _counts(scored, threshold, label_col, score_col)
    rows = F.array(
        F.struct(F.lit(0).alias("label"), F.col("tn").alias("predicted_0"), F.col("fp").alias("predicted_1")),
        F.struct(F.lit(1).alias("label"), F.col("fn").alias("predicted_0"), F.col("tp").alias("predicted_1")),
    )
    return cells.select(F.inline(rows))


def report_from_counts(cells: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and both means."""

    def ratio(numerator: Column, denominator: Column) -> Column:
        return F.coalesce(F.try_divide(numerator.cast("double"), denominator), F.lit(0.0))

    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    negatives, positives = tn + fp, fn + tp
    total = negatives + positives

    def scored_class(hits: Column, predicted: Column, actual: Column) -> tuple[Column, ...]:
        precision, recall = ratio(hits, predicted), ratio(hits, actual)
        return precision, recall, ratio(2 * hits, predicted + actual)

    neg = scored_class(tn, tn + fn, negatives)
    pos = scored_class(tp, tp + fp, positives)
    macro = [(n + p) / 2 for n, p in zip(neg, pos)]
    weighted = [ratio(n * negatives + p * positives, total) for n, p in zip(neg, pos)]
    accuracy = ratio(tn + tp, total)
    none = F.lit(None).cast("double")

    def row(name: str, values, support: Column) -> Column:
        precision, recall, f1 = values
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.alias("support"),
        )

    rows = F.array(
        row(schemas.NEGATIVE_NAME, neg, negatives),
        row(schemas.POSITIVE_NAME, pos, positives),
        row("accuracy", (none, none, accuracy), total),
        row("macro avg", macro, total),
        row("weighted avg", weighted, total),
    )
    return cells.select(F.inline(rows))


def classification_report(
    scored: DataFrame,
    threshold: float = schemas.DECISION_THRESHOLD,
    label_col: str = "label",
    score_col: str = "probability",
) -> DataFrame:
    return report_from_counts(_counts(scored, threshold, label_col, score_col))


def _range_bucket(df: DataFrame, sample_of: DataFrame, column: str, buckets: int) -> DataFrame:
    """Order-preserving bucket number with about equal rows per bucket.

    Cut points come from one distributed quantile sketch (at most ``buckets``
    doubles); the result is exact for any cut points, they only set the balance.
    """
    shares = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(sample_of.approxQuantile(column, shares, 1 / (4 * buckets))))
    if not cuts:
        return df.withColumn("_bucket", F.lit(0))
    splits = [float("-inf"), *cuts, float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol=column, outputCol="_range").transform(df)
    return bucketed.withColumn("_bucket", F.col("_range").cast("int")).drop("_range")


def auroc(
    scored: DataFrame,
    label_col: str = "label",
    score_col: str = "probability",
    buckets: int | None = None,
) -> DataFrame:
    """Area under the ROC curve, ties counted one half (exact Mann-Whitney count).

    Rows collapse to one per distinct score, scores fall into ordered buckets,
    negatives are accumulated inside each bucket in parallel, and only the at
    most ``buckets`` subtotals pass through one ordered window. By default there
    are four buckets per shuffle partition, within fixed bounds.
    """
    if buckets is None:
        partitions = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = min(MAX_RANGES, max(MIN_RANGES, 4 * partitions))
    usable = scored.where(_usable(label_col, score_col))
    rows = usable.select(F.col(label_col).alias("y"), F.col(score_col).alias("s"))
    by_score = rows.groupBy("s").agg(
        F.count_if(F.col("y") == 1).cast("double").alias("pos"),
        F.count_if(F.col("y") == 0).cast("double").alias("neg"),
    )
    bucketed = _range_bucket(by_score, rows, "s", buckets)

    inside = Window.partitionBy("_bucket").orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    below = F.sum("neg").over(inside) - F.col("neg")
    subtotals = (
        bucketed.withColumn("wins", F.col("pos") * (below + 0.5 * F.col("neg")))
        .groupBy("_bucket")
        .agg(F.sum("wins").alias("wins"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    # At most ``buckets`` rows from here on.
    across = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    placed = subtotals.withColumn("neg_before", F.sum("neg").over(across) - F.col("neg"))
    return placed.agg(
        F.try_divide(
            F.sum(F.col("wins") + F.col("pos") * F.col("neg_before")),
            F.sum("pos") * F.sum("neg"),
        ).alias("auroc")
    )


def mean_weighted_loss(
    pos_weight: float, label_col: str, logit_col: str, exact: bool = False
) -> Column:
    """Aggregate: mean weighted binary cross-entropy over the usable rows.

    ``exact`` adds decimals, so the order of the rows changes no bit; losses too large for
    that are added as they are.
    """
    loss = scores.weighted_bce(F.col(label_col), F.col(logit_col), pos_weight)
    usable = F.when(_usable(label_col, logit_col), loss)
    if not exact:
        return F.avg(usable)
    part, n = usable.try_cast("decimal(38,18)"), F.count(usable)
    total = F.when(F.count(part) == n, F.try_sum(part).cast("double"))
    return F.coalesce(F.try_divide(total, n), F.avg(usable))


def weighted_log_loss(
    logits: DataFrame,
    pos_weight: float,
    label_col: str = "label",
    logit_col: str = "logit",
    exact: bool = False,
) -> DataFrame:
    """Mean weighted binary cross-entropy over rows (not over batch means)."""
    return logits.agg(mean_weighted_loss(pos_weight, label_col, logit_col, exact).alias("loss"))


def metric_values(run_metrics: DataFrame, metric: str) -> DataFrame:
    """One metric of a (run_name, step, metric, value) log as its own column."""
    rows = run_metrics.where(F.col("metric") == metric)
    return rows.select("run_name", "step", F.col("value").alias(metric))


def best_epoch(run_metrics: DataFrame, metric_col: str = "val_auroc") -> DataFrame:
    """Best value per run and the first step that reached it; NULL and NaN are no values."""
    run_metrics = run_metrics.where(_is_number(F.col(metric_col)))
    earliest_best = F.min_by("step", F.struct(-F.col(metric_col), F.col("step")))
    return run_metrics.groupBy("run_name").agg(
        F.max(metric_col).alias("best"), earliest_best.alias("best_step")
    )
