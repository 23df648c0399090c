"""Which files of a listing are new, and the newest version of each file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

VERSION = ("path", "modified", "length")


def folder(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def unseen(listing: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows of ``listing`` (path, modified, length, ...) that are not in ``seen``: new files, and files
    with another time or length.

    A file younger than all seen files of its folder is new without a further look; only
    the others are compared with the files seen. Times at the mark are compared, too, so
    no file is missed that came within the resolution of the store's clock. ``seen`` is never
    broadcast: its columns are a small part of its table, but its rows are as many as the files.
    """
    marks = seen.groupBy(folder(F.col("path")).alias("_folder")).agg(F.max("modified").alias("_mark"))
    marked = listing.withColumn("_folder", folder(F.col("path"))).join(marks, "_folder", "left")
    younger = F.col("_mark").isNull() | (F.col("modified") > F.col("_mark"))
    compared = marked.where(~younger).join(
        seen.select(*VERSION).hint("merge"), list(VERSION), "left_anti"
    )
    return marked.where(younger).unionByName(compared).select(listing.columns)


def newest(versions: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Of the rows with one key the one that is last by ``order``."""
    last = F.max_by(F.struct(*versions.columns), F.struct(*order))
    return versions.groupBy(F.col(key).alias("_key")).agg(last.alias("row")).select("row.*")
