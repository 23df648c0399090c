import json
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from roentra.operators import classifier, gold, labels, scoring, split


def scored(spark, rows):
    return spark.createDataFrame(rows, "filename string, probability double, scored_at timestamp_ntz")


def test_predictions_and_alerts(spark):
    at = datetime(2024, 1, 1)
    rows = [("a", 0.5, at), ("b", 0.50001, at), ("c", 0.7, at), ("d", 0.70001, at), ("e", 0.12345, at)]
    predicted = scoring.predictions(scored(spark, rows))
    got = {r["filename"]: (r["pneumonia_probability"], r["prediction"], r["high_confidence_positive"])
           for r in predicted.collect()}
    assert got["a"] == (0.5, "Normal/Other", False)
    assert got["b"] == (0.5, "Pneumonia", False)
    assert got["c"] == (0.7, "Pneumonia", False)
    assert got["d"] == (0.7, "Pneumonia", True)
    alerts = scoring.clinical_alerts(predicted).collect()
    assert [tuple(r) for r in alerts] == [("d", 0.7, at)]


def test_recent_alerts_and_banners(spark):
    rows = [(f"s{i:02d}", 0.9, datetime(2024, 1, 1 + i // 2)) for i in range(30)]
    alerts = scoring.clinical_alerts(scoring.predictions(scored(spark, rows)))
    recent = scoring.recent_alerts(alerts).collect()
    assert len(recent) == 20
    assert [r["filename"] for r in recent[:4]] == ["s28", "s29", "s26", "s27"]
    banners = [r["text"] for r in scoring.alert_banners(alerts).collect()]
    assert len(banners) == 5
    assert banners[0] == "⚠️ **s28** — 90.0% pneumonia probability at 2024-01-15 00:00:00"


@pytest.mark.parametrize(
    "content_type,payload,reason",
    [
        ("image/png", b"[[1, 2], [3, 4]]", None),
        ("image/webp", b"[[1]]", None),
        ("image/png", b"[[1, 2], ", "unreadable"),
        ("image/png", b"\x89PNG\r\n\x1a\n...", "unreadable"),
        ("image/png", b"this is not a valid image file", "unreadable"),
        ("image/png", b"", "unreadable"),
        ("image/png", None, "unreadable"),
        ("text/plain", b"hello world", "not_an_image"),
        ("text/plain", b"\x89PNG\r\n\x1a\n", "not_an_image"),
        (None, b"\x89PNG\r\n\x1a\n", "not_an_image"),
    ],
)
def test_screen_uploads(spark, content_type, payload, reason):
    data = None if payload is None else bytearray(payload)
    df = spark.createDataFrame([(content_type, data)], "content_type string, payload binary")
    screened = scoring.screen_uploads(df, lambda b: np.array(json.loads(b)))
    assert screened.first()["rejected_because"] == reason


def test_uploads_to_scores(spark):
    rows = [
        ("a.png", "image/png", bytearray(json.dumps([[[0, 0, 0]] * 2] * 2).encode())),
        ("b.png", "image/png", bytearray(b"this is not a valid image file")),
        ("c.txt", "text/plain", bytearray(b"hello world")),
        ("d.png", None, None),
        ("e.png", "image/png", None),
    ]
    df = spark.createDataFrame(rows, "filename string, content_type string, content binary")
    found = scoring.score_uploads(
        df, lambda: lambda x: np.zeros(len(x)), lambda b: np.array(json.loads(b)), (2, 2)
    )
    out = {r["filename"]: (r["probability"], r["rejected_because"]) for r in found.collect()}
    assert out == {
        "a.png": (0.5, None), "b.png": (None, "unreadable"), "c.txt": (None, "not_an_image"),
        "d.png": (None, "not_an_image"), "e.png": (None, "unreadable"),
    }


def test_null_features_have_no_probability(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, None), (3, [0.0])], "id int, x array<double>").coalesce(1)
    out = scoring.score_batches(df, "x", lambda: lambda x: x[:, 0]).collect()
    assert [r["probability"] is None for r in out] == [False, True, False]
    none = scoring.score_batches(df.where("id = 2"), "x", lambda: lambda x: x[:, 0]).collect()
    assert [r["probability"] for r in none] == [None]


def test_score_batches_loads_the_model_once_per_task(spark):
    def load():
        weights = np.array([1.0, -2.0])
        return lambda features: features @ weights

    df = spark.range(50).select("id", F.array(F.col("id") / 50, F.lit(0.25)).alias("x"))
    for row in scoring.score_batches(df.repartition(3), "x", load).collect():
        assert row["probability"] == pytest.approx(1 / (1 + np.exp(-(row["id"] / 50 - 0.5))))
        assert 0 <= row["probability"] <= 1


def separable(spark, n=600):
    """Label depends on the first of two features, with some noise; one positive in five."""
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0
    label = (F.col("id") % 5 == 0).cast("int")
    return spark.range(n).select(
        F.col("id").cast("string").alias("image_id"),
        label.alias("label"),
        F.array(label * 0.8 + noise, F.lit(1.0) - noise * 0.1).alias("pixels"),
    )


def test_training_selects_and_evaluates(spark):
    examples = split.assign_patient_splits(separable(spark), "image_id")
    train, val, test = (gold.rows_of_split(examples, s) for s in ("train", "val", "test"))
    trained = classifier.train_weighted(train, val, reg_params=(1.0, 0.01), max_iter=20)
    row = labels.class_weight(train).first()
    assert trained.pos_weight == pytest.approx(row["neg"] / row["pos"])
    log = {(r["step"], r["metric"]): r["value"] for r in trained.run_metrics.collect()}
    assert {m for _, m in log} == {
        "training_set_size", "pos_weight", "reg_param", "train_loss", "val_loss", "val_auroc", "best_val_auroc",
    }
    scored_test = classifier.score(trained.model, test)
    assert scored_test.where("probability NOT BETWEEN 0 AND 1").count() == 0
    result = {r["metric"]: r["value"] for r in classifier.test_metrics(trained, test).collect()}
    assert result["test_auroc"] > 0.9
    assert result["test_loss"] > 0


def test_training_needs_both_classes(spark):
    one_class = separable(spark).where("label = 0")
    with pytest.raises(ValueError):
        classifier.train_weighted(one_class, one_class)
