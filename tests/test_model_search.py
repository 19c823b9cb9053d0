"""Neighbour search of the oversampling, gains by split, approximate quartiles, staging load."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from propensia.operators import model, profile
from propensia.sources import io


def recall(spark, v, **k):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "i long, v array<double>").repartition(4)
    out = model.nearest_rows(df, "i", "v", **k).collect()
    dist = np.sqrt(np.maximum(((v[:, None] - v[None]) ** 2).sum(2), 0))
    np.fill_diagonal(dist, np.inf)
    true = np.sort(dist, 1)[:, :5]
    mine = {}
    for r in out:
        assert r.distance == pytest.approx(dist[r.id, r.neighbour], abs=1e-9)
        mine.setdefault(r.id, []).append((r["rank"], r.distance))
    assert set(mine) == set(range(len(v))) and all([k for k, _ in sorted(x)] == [1, 2, 3, 4, 5] for x in mine.values())
    return np.mean([sum(d <= true[i, -1] + 1e-9 for _, d in x) / 5 for i, x in mine.items()])


def test_recall_of_neighbours(spark):
    """Usage-like rows: a few latent habits, 55 features, many zeros."""
    rng = np.random.default_rng(6)
    v = np.maximum(rng.gamma(1.5, size=(2500, 6)) @ rng.normal(size=(6, 55)) + 0.05 * rng.normal(size=(2500, 55)), 0)
    v = (v - v.mean(0)) / np.where(v.std(0) > 0, v.std(0), 1)
    assert recall(spark, v) >= 0.9


def test_neighbours_are_exact_in_one_bucket_and_split_hot_rows(spark):
    rng = np.random.default_rng(7)
    assert recall(spark, rng.normal(size=(300, 20))) == 1.0
    v = np.concatenate([np.ones((900, 4)), rng.normal(size=(300, 4))])   # three quarters are one point
    df = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "i long, v array<double>")
    out = model.nearest_rows(df, "i", "v", bucket_rows=64, orders=4)
    assert out.groupBy("id").count().where("count = 5").count() == 1200
    assert out.where("id < 900").agg(F.max("distance")).first()[0] == 0


def test_oversampling_lies_between_neighbours(spark):
    rng = np.random.default_rng(8)
    rows = [(i, 2024, 1, float(a), float(b), int(i < 20)) for i, (a, b) in enumerate(rng.normal(size=(120, 2)))]
    rows += [(200 + i, 2024, 1, 50.0 + i, 50.0, 1) for i in range(7)]   # a minority of its own, far off
    df = spark.createDataFrame(rows, "CUST_NUM long, YEAR int, MONTH int, a double, b double, y int")
    out = model.oversample_minority(df, ["a", "b"], "y", k=5)
    assert {(r.y, r.SYNTHETIC): r.n for r in out.groupBy("y", "SYNTHETIC").agg(F.count(F.lit(1)).alias("n")).collect()} == {(0, 0): 100, (1, 0): 27, (1, 1): 73}
    made = out.where("SYNTHETIC = 1").collect()
    assert not [r for r in made if 6 < r.a < 49]   # never between the two groups
    again = {(r.a, r.b) for r in model.oversample_minority(df.repartition(3), ["a", "b"], "y", k=5).where("SYNTHETIC = 1").collect()}
    assert again == {(r.a, r.b) for r in made}


def rows_by_part(df):
    return sorted(r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect())


def test_synthetic_rows_and_the_fits_frame_are_dealt_evenly(spark, monkeypatch):
    """Many synthetic rows of few: no partition of what the trees are fitted on holds more than its share."""
    monkeypatch.setattr(model, "FIT_ROWS", 1000, raising=False)
    rng = np.random.default_rng(10)
    rows = [(i, 2024, 1, float(a), float(b), int(i < 40)) for i, (a, b) in enumerate(rng.normal(size=(4000, 2)))]
    df = spark.createDataFrame(rows, "CUST_NUM long, YEAR int, MONTH int, a double, b double, y int")
    out = model.oversample_minority(df, ["a", "b"], "y").drop("SYNTHETIC")
    assert {tuple(r) for r in out.groupBy("y").count().collect()} == {(0, 3960), (1, 3960)}
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    made = next(i for i, line in enumerate(plan) if "Generate explode" in line)
    assert any("Repartition 4, true" in line for line in plan[made:made + 4])   # the few rows are dealt before many are made of them
    fitted_on, fit = [], model.Pipeline.fit
    monkeypatch.setattr(model.Pipeline, "fit", lambda self, data: (fitted_on.append(data), fit(self, data))[1])
    model.train_gbt(out, ["a", "b"], "y", rows=8000, maxIter=1)
    parts = rows_by_part(fitted_on[0])
    assert sum(parts) == 7920 and len(parts) == 4 and parts[-1] < 1.1 * parts[0]
    want = {tuple(r): r["count"] for r in out.groupBy("a", "b", "y").count().collect()}
    assert {tuple(r): r["count"] for r in fitted_on[0].groupBy("a", "b", F.col("y").cast("int").alias("y")).count().collect()} == want


def test_the_frame_of_several_targets_is_dealt_evenly(spark, monkeypatch):
    monkeypatch.setattr(model, "FIT_ROWS", 1000, raising=False)
    df = spark.range(4000).selectExpr("cast(id % 97 as double) as a", "int(id % 97 > 60) as y", "int(id % 97 < 9) as z").coalesce(1)
    fitted_on, fit = [], model.GBTClassifier.fit
    monkeypatch.setattr(model.GBTClassifier, "fit", lambda self, data: (fitted_on.append(data), fit(self, data))[1])
    found = model.train_targets(df, ["a"], ["y", "z"], maxIter=2)
    assert [rows_by_part(x) for x in fitted_on] == [[1000] * 4] * 2
    assert all(model.score(found[t], df).where((F.col("y_proba") >= 0.5).cast("int") != F.col(t)).count() < 120 for t in found)   # bins hold three values


def test_a_small_frame_keeps_its_partitions(spark):
    df = spark.range(100, numPartitions=1)
    assert model._even(df, 100) is df and model._even(df, model.FIT_ROWS + 1).rdd.getNumPartitions() == 4


def test_split_gains_are_the_models_own(spark):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(float(a), float(b), 1.0, int(a + 0.3 * b > 0)) for a, b in rng.normal(size=(400, 2))], "a double, b double, c double, y int")
    fitted = model.train_gbt(df, ["a", "b", "c"], "y", maxIter=4)
    got = {r.feature: r for r in model.split_gains(spark, fitted, ["a", "b", "c"]).collect()}
    assert (got["c"].n_splits, got["c"].gain, got["c"].importance) == (0, 0.0, 0.0)
    assert {f: got[f].importance for f in got} == pytest.approx(dict(model.feature_importance(fitted, ["a", "b", "c"])))
    trees = fitted.stages[-1].toDebugString
    assert got["a"].n_splits == trees.count("(feature 0 <=") and got["b"].n_splits == trees.count("(feature 1 <=") and got["a"].gain > 0


def test_approximate_quartiles_keep_their_rank_error(spark):
    df = spark.range(200_000).selectExpr("cast(id * 7919 % 200003 as double) as a", "cast(id % 3 as int) as b", "if(id % 2 = 0, null, id) as c", "cast(null as double) as d").repartition(16)
    summary = profile.summary_stats_approx(df, rank_error=0.01)
    assert "Sort" not in summary._jdf.queryExecution().executedPlan().toString()
    errors = {(r.column, r.quantile): r.rank_error for r in profile.quantile_rank_errors(df, summary).collect()}
    assert len(errors) == 12 and all(e is None if c == "d" else e <= 0.01 + 1e-5 for (c, _), e in errors.items())
    wrong = summary.withColumn("p25", F.col("p25") + F.when(F.col("column") == "a", 9000).otherwise(0))
    assert {(r.column, r.quantile): r.rank_error for r in profile.quantile_rank_errors(df, wrong).collect()}["a", 0.25] > 0.04


def test_staging_load_by_column_list(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,Ann,"O, Neil",true,FR,1990-01-02,1 Rd,Lyon,69000,FR,555,a@x\n'
                                    "2,Bo,,no,,1990-02-31,,,,,,\n3,short\n4,Cy,D,,,,,,,,,c@x,one more\n,No,Id,,,,,,,,,n@x\n"
                                    f"5,{'x' * 21},E,false,,,,,,,,e@x\n")
    good, bad = io.load_staging(spark, str(tmp_path))
    assert good.columns == io.LOAD_LIST and "phone_type" not in good.columns
    assert [(r.customer_id, r.last_name, r.gender, str(r.birth_date)) for r in good.collect()] == [("1", "O, Neil", True, "1990-01-02")]
    assert sorted(r.reason for r in bad.collect()) == ["birth_date is no date", "first_name longer than 20", "no customer_id", "not 12 fields", "not 12 fields"]
    with pytest.raises(ValueError, match="nick"):
        io.load_staging(spark, str(tmp_path), ["customer_id", "nick"])
