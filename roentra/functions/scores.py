"""Probability and loss expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from roentra import schemas


def sigmoid(logit: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-logit))


def softplus(x: Column) -> Column:
    """ln(1 + e^x) without overflow for large x."""
    return F.ln(1.0 + F.exp(-F.abs(x))) + F.greatest(x, F.lit(0.0))


def weighted_bce(label: Column, logit: Column, pos_weight: float) -> Column:
    """Binary cross-entropy from a logit, positives weighted."""
    return label * pos_weight * softplus(-logit) + (1 - label) * softplus(logit)


def is_positive(probability: Column, threshold: float = schemas.DECISION_THRESHOLD) -> Column:
    return probability > threshold


def class_name(flag: Column) -> Column:
    return F.when(flag, F.lit(schemas.POSITIVE_NAME)).otherwise(F.lit(schemas.NEGATIVE_NAME))
