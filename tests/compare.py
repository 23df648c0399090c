"""Side-by-side comparison of a query and its SQL counterpart in DuckDB."""

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

SPARK_TO_DUCKDB = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return [(value is None, str(type(value)), str(value)) for value in row]


def differences(df, con, sql):
    """Problems found, as text; empty when columns, types and rows agree."""
    result = con.sql(sql)
    expected_types = dict(zip(result.columns, (str(t) for t in result.types)))
    actual_types = {f.name: SPARK_TO_DUCKDB.get(f.dataType.simpleString()) for f in df.schema}
    names = sorted(actual_types)
    if sorted(expected_types) != names:
        return [f"columns {names} != {sorted(expected_types)}"]
    problems = []
    if expected_types != actual_types:
        problems.append(f"types {actual_types} != {expected_types}")
    actual = sorted((tuple(r) for r in df.select(*names).collect()), key=_key)
    quoted = ", ".join(f'"{n}"' for n in names)
    expected = sorted(con.sql(f"SELECT {quoted} FROM ({sql})").fetchall(), key=_key)
    if len(actual) != len(expected):
        problems.append(f"{len(actual)} rows != {len(expected)}")
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, e.g. {wrong[0]}")
    return problems
