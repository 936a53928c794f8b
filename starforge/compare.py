"""Spark-vs-DuckDB result comparison used by the tests and the local
check tool: row count, column names, and an order-insensitive comparison
of the values (columns sorted by name, floats rounded)."""

from __future__ import annotations

import datetime as _dt
import decimal

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    res["rows_match"] = res["spark_rows"] == res["oracle_rows"]
    if not res["columns_match"]:
        res["spark_cols"], res["oracle_cols"] = sorted(s_cols), sorted(d_cols)
        res["values_match"] = False
        return res
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    res["values_match"] = a == b
    if not res["values_match"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = list(sa - sb)[:3]
        res["only_oracle"] = list(sb - sa)[:3]
    return res
