"""Distributed ranks equal single-window ranks under any partitioning."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from propensia.functions import ranking as rk
from propensia.sources.fixtures import scored

from .conftest import SF01


@pytest.fixture(scope="module")
def sc(spark):
    return scored(spark, SF01).cache()


@pytest.mark.parametrize("parts", [1, 4, 37])
def test_row_number_matches_window(sc, parts):
    got = rk.with_row_number(sc, ["MODEL_TYPE"], [("y_proba", False), ("ROW_ID", True)],
                             "rn", "n", num_partitions=parts).select("ROW_ID", "rn", "n")
    w = Window.partitionBy("MODEL_TYPE").orderBy(F.desc("y_proba"), "ROW_ID")
    want = sc.select("ROW_ID", F.row_number().over(w).alias("rn"),
                     F.count(F.lit(1)).over(Window.partitionBy("MODEL_TYPE")).alias("n"))
    assert got.exceptAll(want).count() == 0
    assert got.count() == sc.count()


@pytest.mark.parametrize("parts", [1, 5, 23])
def test_rank_and_percent_rank_match_window(sc, parts):
    got = rk.with_competition_rank(sc, ["MODEL_TYPE"], "y_proba", False, "rk", num_partitions=parts)
    w = Window.partitionBy("MODEL_TYPE").orderBy(F.desc("y_proba"))
    want = sc.withColumn("rk", F.rank().over(w))
    assert got.select("ROW_ID", "rk").exceptAll(want.select("ROW_ID", "rk")).count() == 0

    got = rk.with_percent_rank(sc, ["MODEL_TYPE"], "y_proba", "pr", num_partitions=parts)
    w = Window.partitionBy("MODEL_TYPE").orderBy("y_proba")
    want = sc.withColumn("pr", F.percent_rank().over(w))
    assert got.select("ROW_ID", "pr").exceptAll(want.select("ROW_ID", "pr")).count() == 0


def test_one_row_group_and_ties(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 1.0), ("b", 1.0), ("b", 3.0)], "g string, v double")
    out = {(r.g, r.v): r.pr for r in rk.with_percent_rank(df, ["g"], "v", "pr").collect()}
    assert out[("a", 5.0)] == 0.0          # one-row partition
    assert out[("b", 1.0)] == 0.0          # ties share the lowest rank
    assert out[("b", 3.0)] == 1.0


def test_prefix_sums_weights(spark):
    df = spark.createDataFrame([(1, 10, 2), (1, 20, 3), (1, 30, 5), (2, 5, 7)], "g int, v int, w int")
    rows = {(r.g, r.v): (r.w_before, r.w_total) for r in rk.prefix_sums(df, ["g"], [("v", True)], ["w"], 3).collect()}
    assert rows == {(1, 10): (0, 10), (1, 20): (2, 10), (1, 30): (5, 10), (2, 5): (0, 7)}


@pytest.mark.parametrize("key", ["split_by_hash", "score_tiles", "model_rank", "report_tiles"])
def test_queries_scale_invariant(spark, key):
    """SURVEY §5.4: the same answer under 1, 4 and 200 shuffle partitions."""
    from propensia.plans.catalog import load_all
    from tests.conftest import SF001
    q = load_all()[key]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in (1, 4, 200):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            df = q.build(spark, SF001)
            results.append(sorted(tuple(r) for r in df.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] and results[0] == results[1] == results[2]
