"""Tables kept in buckets of a key: shuffled and sorted once, at the write, for all later joins.

A join or an aggregate on the key reads such a table without an exchange, and the other
side of a join is dealt to the same buckets. The files lie at a path of the caller's; the
bucket layout, which only a catalog keeps, is written beside them, so that any session
can register the table again.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

LAYOUT = "key string, buckets int, columns string"


def _table_name(path: str) -> str:
    return f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"


def _layout_path(path: str) -> str:
    return f"{path.rstrip('/')}_layout"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Replace the table at ``path``: one file for each bucket, rows sorted by ``key``.

    The rows are dealt to as many tasks as there are buckets first, so that each
    bucket is one file and no exchange is hidden in a later sort.
    """
    spark, name = df.sparkSession, _table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    dealt = df.repartition(buckets, F.col(key))
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    layout = spark.createDataFrame([(key, buckets, columns)], LAYOUT)
    layout.coalesce(1).write.mode("overwrite").json(_layout_path(path))


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table, registered with its bucket layout."""
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        layout = spark.read.schema(LAYOUT).json(_layout_path(path)).first()
        spark.sql(
            f"CREATE TABLE {name} ({layout['columns']}) USING parquet "
            f"CLUSTERED BY (`{layout['key']}`) SORTED BY (`{layout['key']}`) "
            f"INTO {layout['buckets']} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)
