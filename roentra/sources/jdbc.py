"""Database scans. URL, table and credentials come from the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def modulo_predicates(int_expression: str, parts: int) -> list[str]:
    """Disjoint WHERE clauses covering every row, by remainder of an integer SQL expression.

    Negative numbers count from the next multiple below, the smallest integer included,
    so no key is left out. For a text key pass the database's own hash, e.g.
    ``HASHTEXT(patient_id)``.
    """
    rest = f"MOD(MOD({int_expression}, {parts}) + {parts}, {parts})"
    predicates = [f"{rest} = {i}" for i in range(parts)]
    predicates[0] += f" OR {int_expression} IS NULL"
    return predicates


def range_predicates(column: str, bounds: Sequence[str]) -> list[str]:
    """Disjoint WHERE clauses covering every row, by text bounds of a key column, in any order.

    Bounds are sorted by code point; pass bounds that the database's collation orders alike.
    """
    quoted = ["'" + b.replace("'", "''") + "'" for b in sorted(set(bounds))]
    if not quoted:
        return ["1 = 1"]
    first = f"{column} < {quoted[0]} OR {column} IS NULL"
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(quoted, quoted[1:])]
    return [first, *middle, f"{column} >= {quoted[-1]}"]


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Table scan, one task per predicate. Without predicates the scan is a single task."""
    if predicates:
        return spark.read.jdbc(
            url, table, predicates=list(predicates), properties=dict(properties)
        )
    return spark.read.jdbc(url, table, properties=dict(properties))


def read_query(
    spark: SparkSession, url: str, query: str, properties: Mapping[str, str]
) -> DataFrame:
    """Result of a query the database runs, e.g. a DISTINCT over an indexed key."""
    return spark.read.format("jdbc").options(url=url, query=query, **properties).load()


def write_table(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str = "append"
) -> None:
    df.write.jdbc(url, table, mode=mode, properties=dict(properties))
