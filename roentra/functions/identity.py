"""De-identification and file-name expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def pseudonym(patient_id: Column) -> Column:
    """First 16 hex digits of SHA-256; an empty or absent id stays NULL."""
    return F.when(patient_id != "", F.substring(F.sha2(patient_id, 256), 1, 16))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def image_key(path: Column, suffix: str = ".dcm") -> Column:
    """File name with every occurrence of the suffix removed: the key labels join on."""
    return F.replace(base_name(path), F.lit(suffix), F.lit(""))


def join_path(directory: str, name: Column) -> Column:
    return F.concat_ws("/", F.lit(directory.rstrip("/")), name)


def swap_suffix(name: Column, old: str, new: str) -> Column:
    return F.replace(name, F.lit(old), F.lit(new))


def age_number_text(raw_age: Column) -> Column:
    """Age tag without its trailing ``Y`` unit; an empty or absent tag is NULL."""
    return F.when(raw_age != "", F.rtrim(raw_age, F.lit("Y")))


def age_bucket(age_text: Column) -> Column:
    """Ten-year bucket ``lo-hi``; anything that is not a whole number is UNKNOWN."""
    is_whole = age_text.rlike(r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$")
    digits = F.regexp_replace(age_text, r"[\s_]", "")
    age = F.when(is_whole, digits).try_cast("bigint")
    low = age - F.pmod(age, F.lit(10))
    label = F.concat(low.cast("string"), F.lit("-"), (low + 9).cast("string"))
    return F.coalesce(label, F.lit("UNKNOWN"))


def bucket_lower_bound(bucket: Column) -> Column:
    """Lower bound of an age bucket; NULL for UNKNOWN (a plain cast would raise in ANSI mode)."""
    return F.regexp_extract(bucket, r"^(\d+)-", 1).try_cast("int")
