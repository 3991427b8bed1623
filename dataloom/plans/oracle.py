"""Side-by-side check of a Spark query against its DuckDB oracle.

Mirrors the contract of the correctness gate: columns compared by sorted
name, row count, and an order-insensitive hash of normalised values.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math

import duckdb

from dataloom.session import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v, digits: int = 6):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), digits) + 0.0
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x, digits)) for k, x in v.items()))
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return hashlib.md5(repr(norm).encode()).hexdigest(), norm


def compare(spark_df, sql: str, con) -> dict:
    s_cols = list(spark_df.columns)
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    out = {
        "cols_match": sorted(s_cols) == sorted(d_cols),
        "spark_cols": sorted(s_cols),
        "oracle_cols": sorted(d_cols),
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
    }
    sh, sn = _digest(s_cols, s_rows)
    dh, dn = _digest(d_cols, d_rows)
    out["hash_match"] = sh == dh
    out["ok"] = out["cols_match"] and out["hash_match"] and len(s_rows) == len(d_rows)
    if not out["ok"]:
        ds, ss = set(dn), set(sn)
        diff_s = [r for r in sn if r not in ds][:3]
        diff_d = [r for r in dn if r not in ss][:3]
        out["spark_only"] = diff_s
        out["oracle_only"] = diff_d
    return out
