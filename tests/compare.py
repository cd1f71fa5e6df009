"""Compare query results with the checking SQL: names, types, row counts, values."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{folder}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


# Spark type -> DuckDB type that the pandas forms of both engines agree on.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan") if math.isnan(value) else (2, value)
    return (3, str(value)) if not isinstance(value, int) else (2, value)


def differences(df, con, sql: str) -> list[str]:
    names = sorted(df.columns)
    types = dict(df.dtypes)
    found = []
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    theirs = {row[0]: row[1] for row in described}
    if sorted(theirs) != names:
        return [f"columns {names} against {sorted(theirs)}"]
    for n in names:
        if TYPES.get(types[n]) != theirs[n]:
            found.append(f"type of {n}: {types[n]} against {theirs[n]}")
    quoted = ", ".join(f'"{n}"' for n in names)
    expected = con.execute(f"SELECT {quoted} FROM ({sql})").fetchall()
    actual = [tuple(r) for r in df.select(*names).collect()]
    if len(actual) != len(expected):
        found.append(f"{len(actual)} rows against {len(expected)}")
    order = lambda row: tuple(_key(v) for v in row)
    actual.sort(key=order)
    expected.sort(key=order)
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return found
