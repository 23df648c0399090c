"""Header records: de-identified projection and frequency tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from roentra.functions import identity


def deidentified_headers(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw headers plus ``file_path`` -> the 12 silver columns, and any columns in ``keep``.

    An absent tag stays NULL. The raw id and the exact age end here.
    """
    col = F.col
    return raw.select(
        identity.pseudonym(col("patient_id_raw")).alias("patient_id_hash"),
        identity.image_key(col("file_path")).alias("original_filename"),
        "modality",
        "view_position",
        "body_part_examined",
        "patient_sex",
        identity.age_bucket(identity.age_number_text(col("patient_age"))).alias(
            "patient_age_bucket"
        ),
        col("n_rows").alias("rows"),
        col("n_columns").alias("columns"),
        "study_instance_uid",
        "series_instance_uid",
        "file_path",
        *keep,
    )


def age_bucket_counts(headers: DataFrame) -> DataFrame:
    return headers.groupBy("patient_age_bucket").agg(F.count(F.lit(1)).alias("n"))


def value_counts(
    raw: DataFrame,
    fields: Sequence[str] = ("view_position", "modality", "patient_sex"),
    sample: int | None = None,
    order_by: str = "file_name",
) -> DataFrame:
    """Frequency of each value per field, absent values as MISSING.

    ``sample`` keeps the first files by name, for a quick look at a new delivery.
    """
    if sample is not None:
        raw = raw.orderBy(order_by).limit(sample)
    pairs = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("field"), F.coalesce(F.col(name), F.lit("MISSING")).alias("value")
                )
                for name in fields
            ]
        )
    )
    return raw.select(pairs.alias("p")).groupBy("p.field", "p.value").agg(
        F.count(F.lit(1)).alias("n")
    )


def page_headers(pages: DataFrame) -> DataFrame:
    """Header fields of raw markup: language, charset, title and host."""
    html = F.col("html")

    def found(pattern: str):
        return F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))

    return pages.select(
        "page_id",
        found(r'(?i)<html[^>]*\slang="?([A-Za-z-]+)').alias("lang"),
        found(r'(?i)charset="?([A-Za-z0-9_-]+)').alias("charset"),
        found(r"(?is)<title[^>]*>(.*?)</title>").alias("title"),
        F.try_parse_url("url", F.lit("HOST")).alias("host"),
    )


