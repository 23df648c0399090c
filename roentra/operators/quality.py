"""Data-quality checks. Each is one aggregate; results are rows, a failing check raises nothing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from roentra import schemas
from roentra.functions import identity
from roentra.operators.durable import materialize
from roentra.operators.skew import ROWS_PER_SALT, hot_split_join


def check_result(check: str, field: Column | str, total: Column, failing: Column) -> Column:
    field = F.lit(field) if isinstance(field, str) else field
    return F.struct(
        F.lit(check).alias("check_name"),
        failing.cast("bigint").alias("failing_rows"),
        field.alias("field"),
        (failing == 0).alias("passed"),
        total.cast("bigint").alias("total_rows"),
    )


def explode_results(one_row: DataFrame, results: Sequence[Column]) -> DataFrame:
    return one_row.select(F.explode(F.array(*results)).alias("r")).select("r.*")


def schema_completeness(
    df: DataFrame, required: Sequence[str] = schemas.REQUIRED_HEADER_FIELDS
) -> DataFrame:
    """NULLs per required field, all fields in one pass. Empty strings pass."""
    return header_checks(df, required, max_age=None)


def age_range_validity(df: DataFrame, max_age: int = schemas.MAX_PLAUSIBLE_AGE) -> DataFrame:
    """Rows whose age bucket starts above ``max_age``. NULL and UNKNOWN never fail."""
    return header_checks(df, (), max_age)


def header_checks(
    df: DataFrame,
    required: Sequence[str] = schemas.REQUIRED_HEADER_FIELDS,
    max_age: int | None = schemas.MAX_PLAUSIBLE_AGE,
) -> DataFrame:
    """Completeness and age range together: one scan of the headers for both checks."""
    aggregates = [F.count(F.lit(1)).alias("total")]
    results = []
    for i, name in enumerate(required):
        aggregates.append(F.count_if(F.col(name).isNull()).alias(f"missing_{i}"))
        results.append(
            check_result("schema_completeness", name, F.col("total"), F.col(f"missing_{i}"))
        )
    if max_age is not None:
        low = identity.bucket_lower_bound(F.col("patient_age_bucket"))
        aggregates.append(F.count_if(low > max_age).alias("too_old"))
        results.append(
            check_result("age_range_validity", "patient_age_bucket", F.col("total"), F.col("too_old"))
        )
    return explode_results(df.agg(*aggregates), results)


def referential_integrity(headers: DataFrame, class_info: DataFrame) -> DataFrame:
    """Distinct label ids without a header.

    Tags both sides and groups once, instead of an anti-join: one shuffle,
    combined map-side, and NULL is one ordinary id on either side.
    """
    tagged = class_info.select(
        F.col("patient_id").alias("id"), F.lit(True).alias("labelled"), F.lit(False).alias("imaged")
    ).unionByName(
        headers.select(
            F.col("original_filename").alias("id"),
            F.lit(False).alias("labelled"),
            F.lit(True).alias("imaged"),
        )
    )
    ids = tagged.groupBy("id").agg(
        F.max("labelled").alias("labelled"), F.max("imaged").alias("imaged")
    )
    counted = ids.agg(
        F.count_if("labelled").alias("total"),
        F.count_if(F.col("labelled") & ~F.col("imaged")).alias("missing"),
    )
    result = check_result(
        "referential_integrity", "patient_id_to_image", F.col("total"), F.col("missing")
    )
    return explode_results(counted, [result])


def file_digests(files: DataFrame) -> DataFrame:
    """(file_name, content_hash) of (file_name, content); the bytes go no further than this."""
    return files.select("file_name", F.md5("content").alias("content_hash"))


def duplicate_detection(digests: DataFrame, sample: int | None = None) -> DataFrame:
    """Files beyond the first per content hash. All files by default, else the first by name."""
    if sample is not None:
        digests = digests.orderBy("file_name").limit(sample)
    per_hash = digests.groupBy("content_hash").agg(F.count(F.lit(1)).alias("copies"))
    counted = per_hash.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("extra"),
    )
    result = check_result("duplicate_detection", "image_pixel_hash", F.col("total"), F.col("extra"))
    return explode_results(counted, [result])


def duplicate_pairs(files: DataFrame, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Each later file with the first file (by name) of the same content.

    The digests are written once, so the file bytes are read once. The first
    name per hash is a map-side combined minimum, and the join back to the files
    handles hot hashes apart, so a hash shared by very many files is not one task.
    """
    digests = materialize(file_digests(files), "digests")
    firsts = (
        digests.groupBy("content_hash")
        .agg(F.min("file_name").alias("first_file_name"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select(F.col("content_hash").alias("first_hash"), "first_file_name")
    )
    pairs = hot_split_join(digests, firsts, "content_hash", "first_hash", rows_per_salt)
    return pairs.where(F.col("file_name") > F.col("first_file_name")).select(
        "file_name", "first_file_name"
    )


def suite(
    headers: DataFrame,
    class_info: DataFrame,
    digests: DataFrame,
    required: Sequence[str] = schemas.REQUIRED_HEADER_FIELDS,
    max_age: int = schemas.MAX_PLAUSIBLE_AGE,
    sample: int | None = None,
) -> DataFrame:
    """All four checks as rows of one table."""
    parts = [
        header_checks(headers, required, max_age),
        referential_integrity(headers, class_info),
        duplicate_detection(digests, sample),
    ]
    return reduce(DataFrame.unionByName, parts)


def report(results: DataFrame) -> DataFrame:
    """Readable PASS / FAIL lines."""
    status = F.when(F.col("passed"), "PASS").otherwise("FAIL")
    line = F.format_string(
        "[%s] %s (%s): %d/%d failing",
        status,
        F.col("check_name"),
        F.col("field"),
        F.col("failing_rows"),
        F.col("total_rows"),
    )
    return results.select(status.alias("status"), "check_name", "field", line.alias("line"))


def summary(results: DataFrame) -> DataFrame:
    """Number of checks and pass rate per check name."""
    return results.groupBy("check_name").agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.avg(F.col("passed").cast("int")).alias("pass_rate"),
    )
