"""Run registered queries next to their SQL and compare the results."""

from __future__ import annotations

import math
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in data), key=repr)


# Spark type -> the DuckDB type that holds the same values.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, folder: str, query, sql: str) -> dict:
    started = time.time()
    df = query(spark, folder)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - started
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows(names, result.fetchall())
    types = {d[0]: str(d[1]) for d in result.description}
    mapped = {f.name: TYPES.get(f.dataType.simpleString()) for f in df.schema.fields}
    same = types == mapped and got == want
    detail = None
    if not same:
        detail = {
            "columns": sorted(set(types.items()) ^ set(mapped.items())),
            "only_spark": [r for r in got if r not in want][:3] if len(got) < 5000 else [a for a, b in zip(got, want) if a != b][:3],
            "only_duck": [r for r in want if r not in got][:3] if len(want) < 5000 else [b for a, b in zip(got, want) if a != b][:3],
        }
    return {"same": same, "rows": (len(got), len(want)), "seconds": round(took, 2), "detail": detail}
