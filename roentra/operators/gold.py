"""The labelled, split training table and the summaries over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, functions as F

from roentra import schemas
from roentra.operators.labels import patient_labels
from roentra.operators.skew import hot_split_join, salted_join
from roentra.operators.split import assign_patient_splits

# Columns of the training table that come from the patient, not from the header.
OF_PATIENT = ("patient_id", "label", "split")


def labelled_patients(class_info: DataFrame) -> DataFrame:
    """One row per patient with label and split, over all labelled patients (with image or not)."""
    # The label filter drops nothing; it keeps the label in every branch of the
    # split, so all of them read the same shuffle of class_info.
    patients = patient_labels(class_info).where(F.col("label").isNotNull())
    return assign_patient_splits(patients)


def model_ready_rows(
    headers: DataFrame, patients: DataFrame, hot: Sequence[Row] = ()
) -> DataFrame:
    """Headers that have a labelled patient, one row per header, with label and split.

    ``hot`` are the hot file names, found once (``skew.hot_keys``) on the written
    headers; building the plan runs no job.
    """
    own = [c for c in schemas.MODEL_READY.fieldNames() if c not in OF_PATIENT]
    narrow = headers.select(*own)
    joined = hot_split_join(
        narrow, patients, "original_filename", "patient_id", hot=list(hot)
    )
    return joined.select(*schemas.MODEL_READY.fieldNames())


def model_ready(
    headers: DataFrame, class_info: DataFrame, hot: Sequence[Row] = ()
) -> DataFrame:
    return model_ready_rows(headers, labelled_patients(class_info), hot)


def case_counts(gold: DataFrame) -> DataFrame:
    return gold.groupBy("modality", "view_position", "label").agg(
        F.count(F.lit(1)).alias("case_count")
    )


def demographics(gold: DataFrame) -> DataFrame:
    return gold.groupBy("patient_sex", "patient_age_bucket", "label").agg(
        F.count(F.lit(1)).alias("case_count")
    )


def rows_of_split(gold: DataFrame, split: str) -> DataFrame:
    """One split; on the written table this prunes to one partition directory."""
    return gold.where(F.col("split") == split)


def training_examples(
    gold: DataFrame, images: DataFrame, hot: list[Row] | None = None
) -> DataFrame:
    """Gold rows with the pixels of their image (images: image_id, pixels).

    Image ids are unique and the gold side may repeat a file name, so hot names
    are spread over tasks and only their few images are copied. While gold is
    not a written table, ``hot`` is better taken from the headers.
    """
    pixels = images.select(F.col("image_id").cast("string").alias("image_id"), "pixels")
    return salted_join(
        gold.select("original_filename", "label", "split", "file_path"),
        pixels,
        "original_filename",
        "image_id",
        hot=hot,
    ).select("original_filename", "label", "split", "file_path", "pixels")
