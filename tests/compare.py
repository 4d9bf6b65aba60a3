"""Spark-vs-DuckDB result comparison (order-insensitive, columns by name)."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str, tables=("events", "orders")) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return bool(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, rows


def duck_rows(con, sql):
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    data = res.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    rows = [tuple(_norm(r[i]) for i in order) for r in data]
    return cols, rows


def compare(df, con, sql):
    """Return (ok, message)."""
    scols, srows = spark_rows(df)
    dcols, drows = duck_rows(con, sql)
    if scols != dcols:
        return False, f"columns differ: spark={scols} duck={dcols}"
    if len(srows) != len(drows):
        msg = f"row count differs: spark={len(srows)} duck={len(drows)}"
    else:
        msg = None
    cs, cd = Counter(srows), Counter(drows)
    if cs != cd:
        only_s = list((cs - cd).elements())[:5]
        only_d = list((cd - cs).elements())[:5]
        return False, f"{msg or 'values differ'}; cols={scols}\n  spark-only={only_s}\n  duck-only={only_d}"
    return True, f"{len(srows)} rows"
