"""Runs a query in Spark and its SQL twin in DuckDB and compares columns, types and rows."""

from __future__ import annotations

import datetime
import math
import time
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        if Path(f"{sf}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: [(x is None, str(type(x)), str(x)) for x in r])


SPARK_KIND = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "date": "DATE",
}


def compare(spark, con, sf, fn, sql):
    """Returns (problem or None, number of rows, Spark seconds)."""
    start = time.time()
    df = fn(spark, sf)
    got = [tuple(r) for r in df.collect()]
    spent = time.time() - start
    if sql is None:
        return (None if got else "no rows"), len(got), spent
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got), spent
    for c, t in df.dtypes:
        if SPARK_KIND.get(t, t) != kinds[c] and not t.startswith("array"):
            return f"type of {c}: {t} != {kinds[c]}", len(got), spent
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", len(got), spent
    a, b = rows_of(df.columns, got), rows_of(names, want)
    for x, y in zip(a, b):
        if x != y:
            bad = sum(p != q for p, q in zip(a, b))
            return f"{bad} of {len(a)} rows differ: {sorted(names)} {x} != {y}", len(got), spent
    return (None if got else "no rows"), len(got), spent
