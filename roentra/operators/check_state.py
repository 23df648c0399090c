"""The data-quality checks as a state that grows by deliveries, without reading the lake again.

A delivery leaves three narrow rows: counts, which add up exactly, and theta sketches of its
distinct ids and contents, which unite. Results for all deliveries so far are one
aggregate over these rows. Completeness, age range and the number of files are exact.
What depends on distinct values (labelled ids, ids without an image, repeated contents) is
exact while the united sketch holds all values (2^``LOG_SIZE``), and beyond that an
estimate: ``error_bound`` says how far it may be off.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from roentra import schemas
from roentra.functions import identity
from roentra.operators.quality import check_result, explode_results

LOG_SIZE = 16
# Standard deviations that the stated bound allows.
DEVIATIONS = 4

STATE = """headers long, missing array<long>, too_old long, files long,
    label_ids binary, header_ids binary, hashes binary"""


def _distinct(value: Column) -> Column:
    """Sketch of the values, NULL counted as one."""
    known = F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))
    return F.theta_sketch_agg(known, LOG_SIZE)


def delivery_state(
    headers: DataFrame,
    class_info: DataFrame,
    digests: DataFrame,
    required: Sequence[str] = schemas.REQUIRED_HEADER_FIELDS,
    max_age: int = schemas.MAX_PLAUSIBLE_AGE,
) -> DataFrame:
    """State rows of one delivery, each frame read once."""
    low = identity.bucket_lower_bound(F.col("patient_age_bucket"))
    of_headers = headers.agg(
        F.count(F.lit(1)).alias("headers"),
        F.array(*[F.count_if(F.col(c).isNull()) for c in required]).alias("missing"),
        F.count_if(low > max_age).alias("too_old"),
        _distinct(F.col("original_filename")).alias("header_ids"),
    )
    of_labels = class_info.agg(_distinct(F.col("patient_id")).alias("label_ids"))
    of_files = digests.agg(
        F.count(F.lit(1)).alias("files"), _distinct(F.col("content_hash")).alias("hashes")
    )
    empty = headers.sparkSession.createDataFrame([], STATE)
    parts = [of_headers, of_labels, of_files]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts, empty)


def merged_results(
    states: DataFrame, required: Sequence[str] = schemas.REQUIRED_HEADER_FIELDS
) -> DataFrame:
    """The rows of ``quality.suite`` over everything that was delivered."""

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    counts = [total(F.col("missing")[i]).alias(f"missing_{i}") for i in range(len(required))]
    united = [
        F.theta_union_agg(c, LOG_SIZE).alias(c) for c in ("label_ids", "header_ids", "hashes")
    ]
    sums = [total(F.col(c)).alias(c) for c in ("headers", "too_old", "files")]
    one = states.agg(*sums, *counts, *united)
    labelled = F.theta_sketch_estimate("label_ids")
    without = F.theta_sketch_estimate(F.theta_difference("label_ids", "header_ids"))
    distinct = F.theta_sketch_estimate("hashes")
    results = [
        check_result("schema_completeness", c, F.col("headers"), F.col(f"missing_{i}"))
        for i, c in enumerate(required)
    ]
    results += [
        check_result("age_range_validity", "patient_age_bucket", F.col("headers"), F.col("too_old")),
        check_result("referential_integrity", "patient_id_to_image", labelled, without),
        check_result(
            "duplicate_detection",
            "image_pixel_hash",
            F.col("files"),
            F.greatest(F.col("files") - distinct, F.lit(0)),
        ),
    ]
    return explode_results(one, results)


def error_bound(distinct_values: int) -> float:
    """How far a count may be off, with so many distinct values in the sketches it comes from."""
    if distinct_values <= 1 << LOG_SIZE:
        return 0.0
    return DEVIATIONS * distinct_values / math.sqrt((1 << LOG_SIZE) - 1)
