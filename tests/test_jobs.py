"""End-to-end jobs on the smallest fixtures: train, register, score, report."""

from __future__ import annotations

from propensia.plans.featureset import fixture_sources
from propensia.plans.jobs import JobConfig, run_reporting, run_scoring, run_training
from propensia.session import scratch_path
from propensia.sources.fixtures import customers

from .conftest import SF01


def test_train_score_report(spark):
    cfg = JobConfig(root=scratch_path(spark, "jobs"), trees=3)
    src = fixture_sources(spark, SF01)
    out = run_training(spark, src, cfg)
    n_test = out["result"].count()
    assert n_test > 0
    lift = out["lift"].orderBy("TILE").collect()
    assert lift[-1].running_total == n_test
    assert out["sweep"].count() == 18
    auc = out["auc"].collect()[0].AUC
    assert auc is None or 0.0 <= auc <= 1.0
    pred = run_scoring(spark, src, cfg)
    assert pred.where("y_proba < 0 or y_proba > 1").count() == 0 and pred.count() > 0
    rep = run_reporting(spark, {"CHURN": out["result"]}, customers(spark, SF01), cfg)
    assert rep["fact"].count() == n_test
    assert rep["lift"].count() <= 20
