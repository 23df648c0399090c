"""File tables. ``fmt`` is parquet here; delta where its package is on the classpath."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def is_table(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether a table with a known schema lies at the path: a write that broke off is none."""
    try:
        read_table(spark, path, fmt)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False
    return True


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    replace_partitions: bool = False,
    **counts,
) -> dict[str, int]:
    """Write a table and return its row count (``rows``) and any extra aggregate in ``counts``.

    The counts are observed by the write itself, so nothing is computed twice.
    Do not overwrite a path the frame reads from. With ``replace_partitions`` only the
    partitions that the frame has rows of are replaced: they are staged beside the table and
    moved in place at the end, so other files stay and a write that fails changes nothing.
    """
    observation = Observation()
    extra = [expr.alias(name) for name, expr in counts.items()]
    writer = df.observe(observation, F.count(F.lit(1)).alias("rows"), *extra).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if replace_partitions:
        if not partition_by or mode != "overwrite":
            raise ValueError("only partitions that are overwritten can be replaced")
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.format(fmt).mode(mode).save(path)
    return {name: value or 0 for name, value in observation.get.items()}


def write_csv(df: DataFrame, path: str) -> None:
    """CSV export with a header line per file."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV scan with a declared schema: no pass over the data to infer one."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def preview(df: DataFrame, rows: int = 20):
    """First rows as a local frame, for display only."""
    return df.limit(rows).toPandas()
