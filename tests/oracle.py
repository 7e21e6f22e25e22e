"""Side-by-side check of a registered Spark query and its DuckDB oracle.

Both results are normalised the same way (column names sorted, values to a
canonical text form) and compared as multisets, which is what an
order-insensitive value hash checks.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from cairn.session import TABLES, table_path


def duck(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(root, t)}')")
    return con


def _canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_canon(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return _canon(v.asDict())
    return str(v)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_canon(r[c]) for c in cols) for r in df.collect())


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = rel.fetchall()
    return [names[i] for i in order], sorted(tuple(_canon(r[i]) for i in order) for r in rows)


def compare(spark, name, fn, sql, root):
    df = fn(spark, root)
    s_cols, s_rows = spark_rows(df)
    d_cols, d_rows = duck_rows(duck(root), sql)
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns differ: spark={s_cols} duck={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count differs: spark={len(s_rows)} duck={len(d_rows)}")
    elif s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        problems.append(f"values differ, first: {diff}")
    return len(s_rows), problems
