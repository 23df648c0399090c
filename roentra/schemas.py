"""Declared table schemas and the fixed values the data model relies on."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# --- fixed values (must equal the source system's) ---------------------------
POSITIVE_CLASS = "Lung Opacity"
NEGATIVE_NAME = "Normal/Other"
POSITIVE_NAME = "Pneumonia"
TRAIN_SHARE = 0.70
VAL_SHARE = 0.15
SPLIT_SEED = 42
DECISION_THRESHOLD = 0.5
ALERT_THRESHOLD = 0.7
MAX_PLAUSIBLE_AGE = 120
TARGET_SIZE = (224, 224)
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)
REQUIRED_HEADER_FIELDS = (
    "patient_id_hash",
    "original_filename",
    "modality",
    "view_position",
    "patient_sex",
    "rows",
    "columns",
)
ARRIVALS_TOPIC = "dicom-ingestion"
ALERTS_TOPIC = "clinical-alerts"
# Header column -> tag keyword in the image file.
HEADER_TAGS = {
    "patient_id_raw": "PatientID",
    "modality": "Modality",
    "view_position": "ViewPosition",
    "body_part_examined": "BodyPartExamined",
    "patient_sex": "PatientSex",
    "patient_age": "PatientAge",
    "n_rows": "Rows",
    "n_columns": "Columns",
    "study_instance_uid": "StudyInstanceUID",
    "series_instance_uid": "SeriesInstanceUID",
}
# Job names of the audit trail.
JOB_LABELS_INGEST = "postgres_metadata_ingest"
JOB_MANIFEST = "kafka_consumer_image_manifest"
JOB_HEADERS_INGEST = "silver_dicom_metadata_ingest"
JOB_QUALITY = "silver_dq_checks"
JOB_MODEL_READY = "gold_model_ready"
JOB_SUMMARIES = "gold_analytics_summary"
# -----------------------------------------------------------------------------


def _schema(*fields) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in fields])


CLASS_INFO = _schema(("patient_id", StringType), ("class", StringType))

ARRIVAL_EVENT = _schema(
    ("patient_id", StringType),
    ("file_path", StringType),
    ("ingestion_timestamp", DoubleType),
)

IMAGE_MANIFEST = _schema(
    ("patient_id", StringType),
    ("file_path", StringType),
    ("ingestion_timestamp", DoubleType),
    ("consumed_at", StringType),
    ("kafka_offset", LongType),
)

AUDIT_LOG = _schema(
    ("job_name", StringType),
    ("run_timestamp", StringType),
    ("row_count", LongType),
    ("schema", StringType),
    ("notes", StringType),
)

# One image header before de-identification, as a parser hands it over.
RAW_HEADER = _schema(
    ("patient_id_raw", StringType),
    ("modality", StringType),
    ("view_position", StringType),
    ("body_part_examined", StringType),
    ("patient_sex", StringType),
    ("patient_age", StringType),
    ("n_rows", IntegerType),
    ("n_columns", IntegerType),
    ("study_instance_uid", StringType),
    ("series_instance_uid", StringType),
)

HEADERS = _schema(
    ("patient_id_hash", StringType),
    ("original_filename", StringType),
    ("modality", StringType),
    ("view_position", StringType),
    ("body_part_examined", StringType),
    ("patient_sex", StringType),
    ("patient_age_bucket", StringType),
    ("rows", IntegerType),
    ("columns", IntegerType),
    ("study_instance_uid", StringType),
    ("series_instance_uid", StringType),
    ("file_path", StringType),
)

DQ_RESULTS = _schema(
    ("check_name", StringType),
    ("failing_rows", LongType),
    ("field", StringType),
    ("passed", BooleanType),
    ("total_rows", LongType),
)

MODEL_READY = _schema(
    ("patient_id", StringType),
    ("original_filename", StringType),
    ("label", IntegerType),
    ("split", StringType),
    ("modality", StringType),
    ("view_position", StringType),
    ("patient_sex", StringType),
    ("patient_age_bucket", StringType),
    ("rows", IntegerType),
    ("columns", IntegerType),
    ("file_path", StringType),
)

CASE_COUNTS = _schema(
    ("modality", StringType),
    ("view_position", StringType),
    ("label", IntegerType),
    ("case_count", LongType),
)

DEMOGRAPHICS = _schema(
    ("patient_sex", StringType),
    ("patient_age_bucket", StringType),
    ("label", IntegerType),
    ("case_count", LongType),
)

DQ_SUMMARY = _schema(
    ("check_name", StringType),
    ("total_checks", LongType),
    ("pass_rate", DoubleType),
)

PREDICTION = _schema(
    ("filename", StringType),
    ("pneumonia_probability", DoubleType),
    ("prediction", StringType),
    ("high_confidence_positive", BooleanType),
)

CLINICAL_ALERT = _schema(
    ("filename", StringType),
    ("pneumonia_probability", DoubleType),
    ("alert_timestamp", StringType),
)

RUN_METRICS = _schema(
    ("run_name", StringType),
    ("step", LongType),
    ("metric", StringType),
    ("value", DoubleType),
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select exactly the declared columns, in order, with the declared types."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
