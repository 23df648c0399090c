"""Weighted binary classifier on feature arrays, selected on the validation split."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roentra import schemas
from roentra.operators import metrics
from roentra.operators.durable import materialize, new_table_path
from roentra.operators.labels import class_weight
from roentra.operators.pixels import standardize_channels


@dataclass
class TrainedClassifier:
    model: LogisticRegressionModel
    pos_weight: float
    run_metrics: DataFrame
    """(run_name, step, metric, value) of every candidate."""


def image_features(pixels: Column) -> Column:
    """Grey bytes -> the model input that uploads have, too: standardised channels, one after the other."""
    return F.flatten(standardize_channels(pixels.cast("array<double>")))


def _vectors(examples: DataFrame) -> DataFrame:
    return examples.withColumn("features", array_to_vector(image_features(F.col("pixels"))))


def score(model: LogisticRegressionModel, examples: DataFrame) -> DataFrame:
    """Add ``probability`` of the positive class and its ``logit``."""
    scored = model.transform(_vectors(examples))
    return scored.select(
        *examples.columns,
        vector_to_array("probability")[1].alias("probability"),
        vector_to_array("rawPrediction")[1].alias("logit"),
    )


def logits(model: LogisticRegressionModel) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """The model as a loader for ``scoring.score_batches``."""
    weights, bias = model.coefficients.toArray(), float(model.intercept)

    def load() -> Callable[[np.ndarray], np.ndarray]:
        return lambda features: features @ weights + bias

    return load


def _stored(model: LogisticRegressionModel) -> LogisticRegressionModel:
    """The model without its training summary, which cannot be sent to executors in a
    session that has observed a query."""
    path = new_table_path(SparkSession.active(), "classifier")
    model.save(path)
    return LogisticRegressionModel.load(path)


def evaluate_all(
    models: Sequence[LogisticRegressionModel],
    rows: DataFrame,
    pos_weight: float,
    with_auroc: bool = True,
) -> tuple[list[float], list[float | None]]:
    """(losses, AUROCs) of several models over rows (label, features), scored in one scan."""
    scored = rows
    for i, model in enumerate(models):
        named = model.copy().setRawPredictionCol(f"raw{i}").setProbabilityCol(f"chances{i}")
        scored = named.setPredictionCol(f"guess{i}").transform(scored)
    columns = [
        vector_to_array(f"{kind}{i}")[1].alias(f"{name}{i}")
        for i in range(len(models))
        for kind, name in (("raw", "logit"), ("chances", "probability"))
    ]
    narrow = materialize(scored.select("label", *columns), "scored")
    losses = narrow.agg(
        *[metrics.mean_weighted_loss(pos_weight, "label", f"logit{i}") for i in range(len(models))]
    ).first()
    if not with_auroc:
        return list(losses), []
    areas = [metrics.auroc(narrow, "label", f"probability{i}") for i in range(len(models))]
    return list(losses), [area.first()["auroc"] for area in areas]


def train_weighted(
    train: DataFrame,
    val: DataFrame,
    reg_params: Sequence[float] = (0.1, 0.01, 0.001),
    max_iter: int = 50,
    run_name: str = "weighted_logistic",
) -> TrainedClassifier:
    """Fit one candidate per ``reg_params`` on ``train`` (label, pixels), keep the best on ``val``.

    Positive rows weigh negatives / positives of the training rows. A later
    candidate replaces the best only when its validation AUROC is strictly higher.
    """
    spark = train.sparkSession
    balance = class_weight(train).first()
    pos_weight = balance["pos_weight"]
    if not pos_weight:
        raise ValueError("training rows must hold both classes")
    weight = F.when(F.col("label") == 1, F.lit(pos_weight)).otherwise(F.lit(1.0))
    # Features are made from pixels once, for all fits and evaluations.
    weighted = materialize(
        _vectors(train).select("label", "features", weight.alias("weight")), "train-vectors"
    )
    checks = materialize(_vectors(val).select("label", "features"), "val-vectors")

    candidates = []
    for reg in reg_params:
        learner = LogisticRegression(
            labelCol="label", weightCol="weight", regParam=reg, maxIter=max_iter
        )
        candidates.append(_stored(learner.fit(weighted)))
    train_losses, _ = evaluate_all(candidates, weighted, pos_weight, with_auroc=False)
    val_losses, val_aurocs = evaluate_all(candidates, checks, pos_weight)
    if None in val_aurocs:
        raise ValueError("validation rows must hold both classes")

    best, best_auroc = None, 0.0
    log = [
        (run_name, 0, "training_set_size", float(balance["neg"] + balance["pos"])),
        (run_name, 0, "pos_weight", pos_weight),
    ]
    for step, (reg, candidate) in enumerate(zip(reg_params, candidates)):
        log += [
            (run_name, step, "reg_param", float(reg)),
            (run_name, step, "train_loss", train_losses[step]),
            (run_name, step, "val_loss", val_losses[step]),
            (run_name, step, "val_auroc", val_aurocs[step]),
        ]
        if best is None or val_aurocs[step] > best_auroc:
            best, best_auroc = candidate, val_aurocs[step]
    log.append((run_name, len(reg_params) - 1, "best_val_auroc", best_auroc))
    return TrainedClassifier(best, pos_weight, spark.createDataFrame(log, schemas.RUN_METRICS))


def test_metrics(trained: TrainedClassifier, test: DataFrame) -> DataFrame:
    """(run_name, step, metric, value) rows of the selected model on the test split."""
    return evaluation_rows(score(trained.model, test), trained.pos_weight)


def objective_gradient(
    trained: TrainedClassifier, train: DataFrame, reg_param: float
) -> DataFrame:
    """(feature, gradient): slope of the weighted loss with its penalty at the fitted weights.

    The penalty is on the weights of features scaled to unit deviation, as the learner has it.
    """
    fitted = F.array(*[F.lit(float(c)) for c in trained.model.coefficients])
    w = F.when(F.col("label") == 1, F.lit(trained.pos_weight)).otherwise(F.lit(1.0))
    scored = score(trained.model, train).select(
        w.alias("w"),
        (F.col("probability") - F.col("label")).alias("error"),
        F.posexplode(image_features(F.col("pixels"))).alias("feature", "x"),
    )
    sums = scored.groupBy("feature").agg(
        F.sum("w").alias("sum_w"),
        F.sum(F.col("w") * F.col("w")).alias("sum_ww"),
        F.sum(F.col("w") * F.col("x")).alias("sum_wx"),
        F.sum(F.col("w") * F.col("x") * F.col("x")).alias("sum_wxx"),
        F.sum(F.col("w") * F.col("error") * F.col("x")).alias("slope"),
    )
    total = F.col("sum_w")
    spread = (F.col("sum_wxx") - F.col("sum_wx") * F.col("sum_wx") / total) / (
        total - F.col("sum_ww") / total
    )
    penalty = F.lit(reg_param) * F.element_at(fitted, F.col("feature") + 1) * spread
    return sums.select("feature", (F.col("slope") / total + penalty).alias("gradient"))


def evaluation_rows(scored: DataFrame, pos_weight: float) -> DataFrame:
    """(run_name, step, metric, value) rows of a scored test split (label, probability, logit)."""
    loss = metrics.weighted_log_loss(scored, pos_weight).select(
        F.lit("test_loss").alias("metric"), F.col("loss").alias("value")
    )
    area = metrics.auroc(scored).select(
        F.lit("test_auroc").alias("metric"), F.col("auroc").alias("value")
    )
    both = loss.unionByName(area)
    return both.select(
        F.lit("final_test_evaluation").alias("run_name"),
        F.lit(0).cast("bigint").alias("step"),
        "metric",
        "value",
    )
