"""Every registered query against its DuckDB oracle on sf0.001 (the driver
does the same at sf0.01); rows-only keys must run and return rows."""

from __future__ import annotations

import math

import duckdb
import pandas as pd
import pytest

from propensia.plans.catalog import load_all

from .conftest import SF001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2 ** 53:
            return int(v)
        return float(f"{v:.10g}")
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _canon(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return con


REG = load_all()


@pytest.mark.parametrize("key", sorted(REG))
def test_query_against_oracle(spark, duck, key):
    q = REG[key]
    got = q.build(spark, SF001).toPandas()
    if q.oracle is None:
        assert len(got.columns) > 0
        return
    want = duck.execute(q.oracle).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _canon(got) == _canon(want)


def test_entry_smoke(spark):
    import importlib.util
    import os
    path = os.path.join(os.path.dirname(os.path.dirname(__file__)), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() > 0
    assert set(mod.oracle_sql()) <= set(mod.queries())
