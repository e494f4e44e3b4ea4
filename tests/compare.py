"""Compares registered queries with their SQL, value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def kind(value):
    if isinstance(value, bool):
        return "bool"
    return type(value).__name__


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    spark_rows = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    sql_columns = [d[0] for d in cursor.description]
    sql_rows = cursor.fetchall()
    if sorted(df.columns) != sorted(sql_columns):
        return f"columns {sorted(df.columns)} against {sorted(sql_columns)}"
    left, right = table(df.columns, spark_rows), table(sql_columns, sql_rows)
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}; first {left[:2]} / {right[:2]}"
    names = sorted(df.columns)
    for a, b in zip(left, right):
        for name, x, y in zip(names, a, b):
            if x is not None and y is not None and kind(x) != kind(y):
                return f"{name}: {kind(x)} {x!r} against {kind(y)} {y!r}"
            if x != y:
                return f"{name}: {x!r} against {y!r} in {a} / {b}"
    return None
