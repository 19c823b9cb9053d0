"""Run each registered query in Spark and its oracle SQL in DuckDB, compare.

usage: python tools/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, ".")

from propensia.session import build_session  # noqa: E402
from propensia.plans.catalog import load_all  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2**53:
            return int(v)
        return float(f"{v:.10g}")
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = build_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    reg = load_all()
    bad = 0
    for key, q in reg.items():
        if keys and key not in keys:
            continue
        t0 = time.time()
        try:
            sdf = q.build(spark, sf)
            sp = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {key}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.oracle is None:
            print(f"rows {key}: {len(sp)} rows ({ts:.1f}s, no oracle)")
            continue
        try:
            dd = con.execute(q.oracle).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {key}: duckdb error {str(e)[:300]}")
            bad += 1
            continue
        if sorted(sp.columns) != sorted(dd.columns):
            print(f"FAIL {key}: columns differ\n  spark={list(sp.columns)}\n  duck ={list(dd.columns)}")
            bad += 1
            continue
        a, b = canon(sp), canon(dd)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            print(f"FAIL {key}: rows spark={len(a)} duck={len(b)} first diffs={diff}")
            bad += 1
        else:
            print(f"ok   {key}: {len(a)} rows ({ts:.1f}s)")
    print(f"{bad} failures")


if __name__ == "__main__":
    main()
