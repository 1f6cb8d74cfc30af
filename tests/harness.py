"""Spark result against DuckDB oracle, compared like the driver does:
columns sorted by name, row count, and the multiset of row values."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    cols = [columns[i].lower() for i in order]
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return cols, out


# Spark type name -> DuckDB type name
TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
              "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}


def compare(df, con, sql):
    s_types = {c.lower(): TYPE_NAMES.get(t, t) for c, t in df.dtypes}
    s_cols, s_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    d_types = {d[0].lower(): str(d[1]) for d in res.description}
    d_cols_raw = [d[0] for d in res.description]
    d_cols, d_rows = rows_of(d_cols_raw, res.fetchall())
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns {s_cols} != {d_cols}")
    elif s_types != d_types:
        problems.append(f"types {s_types} != {d_types}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows {len(s_rows)} != {len(d_rows)}")
    elif s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(s_rows)
