import math
import random

import pytest

from roentra.operators import metrics


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, probability double")


def pairwise_auroc(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("buckets", [2, 7, 1024])
@pytest.mark.parametrize("digits", [1, 2, 9])
def test_auroc_equals_pairwise_definition(spark, buckets, digits):
    rng = random.Random(buckets * 10 + digits)
    rows = [(int(rng.random() < 0.3), round(rng.random() ** 4, digits)) for _ in range(700)]
    rows += [(i % 2, 0.5) for i in range(350)]  # a third of the rows share one score
    got = metrics.auroc(scored(spark, rows).repartition(5), buckets=buckets).first()["auroc"]
    assert got == pytest.approx(pairwise_auroc(rows), abs=1e-12)


@pytest.mark.parametrize(
    "rows,expected",
    [
        ([(0, 0.1), (1, 0.9)], 1.0),
        ([(1, 0.1), (0, 0.9)], 0.0),
        ([(0, 0.5), (1, 0.5)], 0.5),
        ([(1, 0.5), (1, 0.6)], None),
        ([], None),
    ],
)
def test_auroc_edges(spark, rows, expected):
    assert metrics.auroc(scored(spark, rows)).first()["auroc"] == expected


def test_confusion_matrix_threshold_is_strict(spark):
    rows = [(0, 0.5), (1, 0.5), (1, 0.51), (0, 0.9)]
    got = [tuple(r) for r in metrics.confusion_matrix(scored(spark, rows)).collect()]
    assert got == [(0, 1, 1), (1, 1, 1)]


def test_report_of_published_cells(spark):
    cells = spark.createDataFrame([(280, 56, 45, 42)], "tn long, fp long, fn long, tp long")
    rows = {r["class"]: r for r in metrics.report_from_counts(cells).collect()}

    def rounded(name):
        return tuple(round(rows[name][c], 2) for c in ("precision", "recall", "f1"))

    assert rounded("Normal/Other") == (0.86, 0.83, 0.85)
    assert rounded("Pneumonia") == (0.43, 0.48, 0.45)
    assert rows["accuracy"]["f1"] == pytest.approx(322 / 423)
    assert rows["accuracy"]["precision"] is None
    assert rows["weighted avg"]["support"] == 423


def test_report_without_predictions_of_a_class(spark):
    rows = metrics.classification_report(scored(spark, [(0, 0.1), (1, 0.2)])).collect()
    positive = next(r for r in rows if r["class"] == "Pneumonia")
    assert (positive["precision"], positive["recall"], positive["f1"], positive["support"]) == (0, 0, 0, 1)


def test_weighted_log_loss(spark):
    rows = [(1, 2.0), (0, -1.0), (1, -800.0)]
    df = spark.createDataFrame(rows, "label int, logit double")

    def one(y, x):
        return 3.0 * math.log1p(math.exp(-x)) if y else math.log1p(math.exp(x))

    expected = (one(1, 2.0) + one(0, -1.0) + 3.0 * 800.0) / 3
    assert metrics.weighted_log_loss(df, 3.0).first()["loss"] == pytest.approx(expected)


def test_best_epoch_is_the_earliest_best(spark):
    rows = [("a", 0, 0.5), ("a", 1, 0.7), ("a", 2, 0.7), ("b", 0, 0.1)]
    df = spark.createDataFrame(rows, "run_name string, step long, val_auroc double")
    assert {tuple(r) for r in metrics.best_epoch(df).collect()} == {("a", 0.7, 1), ("b", 0.1, 0)}


def test_rows_without_score_or_label_count_nowhere(spark):
    rows = [(1, 0.9), (0, 0.1), (1, None), (None, 0.4), (0, float("nan")), (1, 0.2)]
    df = scored(spark, rows)
    assert tuple(metrics.score_quality(df).first()) == (6, 3, 2, 1)
    assert [tuple(r) for r in metrics.confusion_matrix(df).collect()] == [(0, 1, 0), (1, 1, 1)]
    assert metrics.auroc(df).first()["auroc"] == 1.0


def test_best_epoch_ignores_missing_values(spark):
    nan = float("nan")
    rows = [("a", 0, None), ("a", 1, nan), ("a", 2, 0.9), ("a", 3, 0.5), ("b", 0, None)]
    df = spark.createDataFrame(rows, "run_name string, step long, val_auroc double")
    assert [tuple(r) for r in metrics.best_epoch(df).collect()] == [("a", 0.9, 2)]


def test_an_exact_loss_has_no_order(spark):
    rows = [(i % 2, 0.37 * i - 40.0) for i in range(300)] + [(None, 1.0), (1, None), (0, float("nan"))]

    def loss(some, exact=True):
        frame = spark.createDataFrame(some, "label int, logit double").coalesce(1)
        return metrics.weighted_log_loss(frame, 2.5, exact=exact).first()["loss"]

    assert len({loss(rows[i:] + rows[:i]) for i in (0, 77, 150, 290)}) == 1
    assert loss(rows) == pytest.approx(loss(rows, exact=False), rel=1e-14)
    assert loss([(None, 1.0)]) is None
    # Losses beyond decimals are added as they are.
    assert loss([(0, 1e30), (0, 3e30)]) == pytest.approx(2e30)
    assert loss([(0, float("inf")), (0, 1.0)]) == float("inf")
