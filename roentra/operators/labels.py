"""Labels per patient."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roentra import schemas


def with_binary_label(class_info: DataFrame, class_col: str = "class") -> DataFrame:
    """1 for the positive class, 0 for every other class and for NULL."""
    is_positive = F.col(class_col) == schemas.POSITIVE_CLASS
    return class_info.withColumn("label", F.when(is_positive, F.lit(1)).otherwise(F.lit(0)))


def patient_labels(class_info: DataFrame) -> DataFrame:
    """One row per patient, positive if any of its rows is. Combines map-side, so hot ids are cheap."""
    return (
        with_binary_label(class_info).groupBy("patient_id").agg(F.max("label").alias("label"))
    )


def distinct_count(df: DataFrame, column: str, alias: str = "n") -> DataFrame:
    """Number of distinct values, NULL counted as one value (count_distinct would skip it)."""
    return df.select(column).distinct().agg(F.count(F.lit(1)).alias(alias))


def class_weight(labelled: DataFrame, label_col: str = "label") -> DataFrame:
    """One row: negatives, positives and their ratio, the weight of a positive row."""
    label = F.col(label_col)
    return labelled.agg(
        F.count_if(label == 0).alias("neg"), F.count_if(label == 1).alias("pos")
    ).withColumn("pos_weight", F.try_divide(F.col("neg").cast("double"), F.col("pos")))
