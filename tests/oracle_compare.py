"""Spark-vs-DuckDB comparison of registered queries (used by tests and by hand).

    python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _digest(columns, rows) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None, con=None) -> dict:
    from lookback.catalog import QUERIES as qs
    from lookback.oracle import ORACLE_SQL as sql
    con = con or duck_connect(sf_dir)
    out = {}
    for name in names or list(qs):
        t = time.time()
        df = qs[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        ts = time.time() - t
        res = {"rows": len(s_rows), "spark_sec": round(ts, 2)}
        if name in sql:
            t = time.time()
            cur = con.execute(sql[name])
            d_cols = [c[0] for c in cur.description]
            d_rows = cur.fetchall()
            res.update({
                "oracle_rows": len(d_rows),
                "cols_match": sorted(s_cols) == sorted(d_cols),
                "hash_match": sorted(s_cols) == sorted(d_cols)
                and _digest(s_cols, s_rows) == _digest(d_cols, d_rows),
                "oracle_sec": round(time.time() - t, 2),
            })
            if not res["cols_match"]:
                res["cols"] = (s_cols, d_cols)
        out[name] = res
    return out


if __name__ == "__main__":
    from lookback.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(8)
    res = compare(spark, sf, names)
    bad = 0
    for k, v in res.items():
        ok = v.get("hash_match", True) and v.get("rows") == v.get("oracle_rows", v.get("rows"))
        bad += not ok
        print(("OK  " if ok else "BAD ") + k, v, flush=True)
    print("mismatches:", bad)
