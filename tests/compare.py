"""Compare a Spark result with the rows of the second engine: names, number of rows, values."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v if v is None else f"{type(v).__name__}:{v!r}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(row[i]) or "" for i in order) for row in rows)


def compare(df, sql: str, con) -> dict:
    started = time.time()
    got = rows_of(df.columns, df.collect())
    spark_secs = time.time() - started
    started = time.time()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    problems = []
    if sorted(df.columns) != sorted(names):
        problems.append(f"columns {sorted(set(df.columns) ^ set(names))}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    elif got != want:
        bad = next((g, w) for g, w in zip(got, want) if g != w)
        diff = [(n, g, w) for n, g, w in zip(sorted(names), *bad) if g != w]
        problems.append(f"values {diff[:4]}")
    return {"rows": len(got), "spark": spark_secs, "sql": time.time() - started, "problems": problems}
