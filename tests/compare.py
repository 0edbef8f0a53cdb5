"""Order-insensitive comparison of a Spark result with a DuckDB oracle (names, rows, values)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr), [names[i] for i in order]


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_names = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_names = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    s_sorted, s_cols = rows_of(s_names, s_rows)
    d_sorted, d_cols = rows_of(d_names, d_rows)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} oracle={d_cols}"
    if len(s_sorted) != len(d_sorted):
        return False, f"row counts differ: spark={len(s_sorted)} oracle={len(d_sorted)}"
    if s_sorted != d_sorted:
        diff = [(a, b) for a, b in zip(s_sorted, d_sorted) if a != b][:3]
        return False, f"values differ ({len(s_sorted)} rows), first: {diff}"
    return True, f"{len(s_sorted)} rows"
