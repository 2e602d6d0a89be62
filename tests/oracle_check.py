"""Side-by-side check of queries() against oracle_sql() (driver-like).

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Compares row count, column names and an order-insensitive value hash.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer():  # pandas turns nullable ints into floats on one side
            return int(v)
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def frame_hash(df: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(df.columns)
    rows = []
    for rec in df[cols].itertuples(index=False, name=None):
        rows.append(json.dumps([_norm(v) for v in rec], default=str))
    rows.sort()
    return len(rows), cols, hashlib.sha256("\n".join(rows).encode()).hexdigest()


def compare(spark, sf_dir: str, keys=None) -> dict:
    import __spark_entry__ as entry

    qs, oracle = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in keys or sorted(qs):
        t0 = time.time()
        sdf = qs[name](spark, sf_dir).toPandas()
        t1 = time.time()
        if name not in oracle:
            out[name] = {"rows": len(sdf), "oracle": None, "sec": round(t1 - t0, 2)}
            continue
        odf = con.execute(oracle[name]).df()
        a, b = frame_hash(sdf), frame_hash(odf)
        res = {"rows": [a[0], b[0]], "cols": a[1] == b[1], "hash": a[2] == b[2], "sec": round(t1 - t0, 2)}
        if a[1] != b[1]:
            res["col_diff"] = [sorted(set(a[1]) - set(b[1])), sorted(set(b[1]) - set(a[1]))]
        out[name] = res
    return out


if __name__ == "__main__":
    from listenlab.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = get_spark()
    res = compare(spark, sf, keys)
    bad = 0
    for k, v in res.items():
        ok = v.get("oracle", 1) is None or (v["cols"] and v["hash"] and v["rows"][0] == v["rows"][1])
        bad += not ok
        print(("OK  " if ok else "FAIL"), k, v)
    print(f"{len(res) - bad}/{len(res)} ok")
