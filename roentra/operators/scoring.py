"""Scoring rows, predictions and alerts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from roentra import schemas
from roentra.functions import scores
from roentra.operators.pixels import rgb_pixels, upload_features

def is_image(content_type: Column) -> Column:
    return F.coalesce(F.startswith(content_type, F.lit("image/")), F.lit(False))


def readable(payload: Column, decode: Callable[[bytes], np.ndarray] = rgb_pixels) -> Column:
    """True when the decoder reads the whole payload."""

    @F.pandas_udf("boolean")
    def decodes(batch: pd.Series) -> pd.Series:
        def good(content) -> bool:
            try:
                return content is not None and decode(content) is not None
            except Exception:
                return False

        return batch.map(good, na_action=None).astype(bool)

    return decodes(payload)


def screen_uploads(
    uploads: DataFrame,
    decode: Callable[[bytes], np.ndarray] = rgb_pixels,
    content_type: str = "content_type",
    payload: str = "payload",
) -> DataFrame:
    """Add ``rejected_because``: not_an_image, unreadable (the decoder fails), or NULL for
    accepted rows."""
    image = is_image(F.col(content_type))
    reads = readable(F.when(image, F.col(payload)), decode)
    reason = F.when(~image, "not_an_image").when(~reads, "unreadable")
    return uploads.withColumn("rejected_because", reason)


def score_uploads(
    uploads: DataFrame,
    load_model: Callable[[], Callable[[np.ndarray], np.ndarray]],
    decode: Callable[[bytes], np.ndarray] = rgb_pixels,
    target: tuple[int, int] = schemas.TARGET_SIZE,
) -> DataFrame:
    """Uploads (filename, content_type, content) -> (filename, probability, rejected_because).

    Every payload is decoded once: its features are scored, or the decoder's failure rejects it.
    """
    image = is_image(F.col("content_type"))
    features = upload_features(uploads.where(image), decode, target)
    unreadable = F.when(F.col("error").isNotNull(), "unreadable")
    scored = score_batches(features, "features", load_model).select(
        "filename", "probability", unreadable.alias("rejected_because")
    )
    others = uploads.where(~image).select(
        "filename",
        F.lit(None).cast("double").alias("probability"),
        F.lit("not_an_image").alias("rejected_because"),
    )
    return scored.unionByName(others)


def predictions(
    scored: DataFrame, alert_threshold: float = schemas.ALERT_THRESHOLD
) -> DataFrame:
    """Prediction rows; both thresholds apply to the unrounded probability. Other columns stay."""
    p = F.col("probability")
    return scored.select(
        *[c for c in scored.columns if c != "probability"],
        F.round(p, 4).alias("pneumonia_probability"),
        scores.class_name(scores.is_positive(p)).alias("prediction"),
        (p > alert_threshold).alias("high_confidence_positive"),
    )


def clinical_alerts(predicted: DataFrame, timestamp: Column | None = None) -> DataFrame:
    """Flagged predictions as alert rows; ``timestamp`` defaults to the scored_at column."""
    stamp = F.col("scored_at") if timestamp is None else timestamp
    return predicted.where("high_confidence_positive").select(
        "filename", "pneumonia_probability", stamp.alias("alert_timestamp")
    )


def score_batches(
    df: DataFrame,
    feature_col: str,
    load_model: Callable[[], Callable[[np.ndarray], np.ndarray]],
    output_col: str = "probability",
) -> DataFrame:
    """Add the probability of a model that is loaded once per task; NULL features give NULL.

    ``load_model`` runs on the executor and returns a function from a
    (rows x features) matrix to one logit per row.
    """

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for batch in batches:
            known = batch.notna().to_numpy()
            out = np.full(len(batch), np.nan)
            if known.any():
                logits = model(np.stack(batch[known].to_numpy()).astype(np.float64))
                out[known] = 1.0 / (1.0 + np.exp(-logits))
            yield pd.Series(out).astype("Float64").where(known, None)

    return df.withColumn(output_col, score(F.col(feature_col)))


def recent_alerts(alerts: DataFrame, limit: int = 20) -> DataFrame:
    """Newest alerts for display."""
    return alerts.orderBy(
        F.desc("alert_timestamp"), F.asc("filename"), F.desc("pneumonia_probability")
    ).limit(limit)


def alert_banners(alerts: DataFrame, limit: int = 5) -> DataFrame:
    """Banner text of the newest alerts."""
    # Fixed value: the banner's format.
    text = F.format_string(
        "⚠️ **%s** — %.1f%% pneumonia probability at %s",
        F.col("filename"),
        F.col("pneumonia_probability") * 100,
        F.date_format("alert_timestamp", "yyyy-MM-dd HH:mm:ss"),
    )
    return recent_alerts(alerts, limit).select(text.alias("text"))
