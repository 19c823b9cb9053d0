"""End-to-end jobs: the monthly training run, the scoring run and the
reporting tables, each a chain of the operators writing its tables once.

Every table is written with ``save_table`` (one overwrite per table) and
read back by the next step, so a step that fails can be re-run alone and no
step recomputes another's lineage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import standardize_events
from ..functions.columns import cast_features, feature_columns, fill_missing_numeric
from ..operators import assemble as asm
from ..operators import customers as cu
from ..operators import evaluate as ev
from ..operators import labels as lb
from ..operators import model as ml
from ..sources.io import save_table
from .featureset import build_feature_tables


@dataclass
class JobConfig:
    root: str                        # shared folder for tables and models
    target: str = "CHURN"            # CHURN, SPORT or CINEMA
    train_threshold: float = 0.01
    scoring_threshold: float = 0.16
    trees: int = 100
    oversample: bool = True
    dedupe: bool = False             # the reference computes but discards de-duplication


def _t(cfg: JobConfig, name: str) -> tuple[str, str]:
    return name, f"{cfg.root.rstrip('/')}/tables/{name}"


def run_training(spark: SparkSession, sources: dict[str, DataFrame], cfg: JobConfig) -> dict[str, DataFrame]:
    """Feature tables → assembled, labelled set → model → test-set results,
    lift table, threshold sweep, AUC. Returns the written tables."""
    target_col = f"TARGET_{cfg.target}"
    pred_col = f"PREDICTION_{cfg.target}"
    feats = build_feature_tables(sources, "train", dedupe=cfg.dedupe, with_requests=False)
    out = {}
    for name, df in [("internet", feats.internet), ("tv", feats.tv), ("mobile", feats.mobile),
                     ("socio", feats.socio), ("journeys", feats.journeys)]:
        out[f"features_{name}_train"] = save_table(df, *_t(cfg, f"features_{name}_train"))
    assembled = asm.assemble(out["features_tv_train"], out["features_internet_train"],
                             out["features_mobile_train"], out["features_socio_train"],
                             out["features_journeys_train"])
    requests = standardize_events(sources["requests"]).drop("EVT_DT")
    labelled = lb.label_next_month(assembled, requests, lb.TARGET_EVENTS[cfg.target], target_col)
    labelled = save_table(labelled, *_t(cfg, f"training_{cfg.target.lower()}"))
    out["training"] = labelled

    data = fill_missing_numeric(labelled)
    features = feature_columns(data, exclude=[target_col])
    data = lb.split_by_hash(cast_features(data, features))
    data = save_table(data, *_t(cfg, f"training_{cfg.target.lower()}_split"))
    train = data.where(F.col("SPLIT") == "train").drop("SPLIT")
    test = data.where(F.col("SPLIT") == "test").drop("SPLIT")
    if cfg.oversample:
        train = ml.oversample_minority(train, features, target_col).drop("SYNTHETIC")
    model = ml.train_gbt(train, features, target_col, maxIter=cfg.trees)
    ml.register_model(spark, model, f"{cfg.root.rstrip('/')}/models", f"{cfg.target.lower()}_model")

    scored = ev.apply_threshold(ml.score(model, test), cfg.train_threshold, pred_col=pred_col)
    scored = scored.select("CUST_NUM", "YEAR", "MONTH", target_col, pred_col, "y_proba",
                           "THRESHOLD_USED", *features)
    result = save_table(scored, *_t(cfg, f"train_result_{cfg.target.lower()}"))
    out["result"] = result
    ev_in = result.select(F.lit(cfg.target).alias("MODEL_TYPE"), F.col(target_col).alias("TARGET"),
                          "y_proba", *lb.KEYS)
    ev_in = save_table(ev_in, *_t(cfg, f"eval_input_{cfg.target.lower()}"))
    out["lift"] = save_table(ev.lift_table(ev.score_tiles(ev_in, tie_col=lb.KEYS)), *_t(cfg, f"lift_{cfg.target.lower()}"))
    out["sweep"] = save_table(ev.threshold_sweep(ev_in), *_t(cfg, f"sweep_{cfg.target.lower()}"))
    out["auc"] = save_table(ev.roc_auc(ev_in), *_t(cfg, f"auc_{cfg.target.lower()}"))
    return out


def run_scoring(spark: SparkSession, sources: dict[str, DataFrame], cfg: JobConfig) -> DataFrame:
    """Scoring-window features → assembled set → latest model → thresholded
    predictions table."""
    feats = build_feature_tables(sources, "score", dedupe=cfg.dedupe, with_requests=False)
    assembled = asm.assemble(feats.tv, feats.internet, feats.mobile, feats.socio, feats.journeys)
    data = fill_missing_numeric(assembled)
    features = asm.feature_columns_in_order()
    data = cast_features(data, features)
    model = ml.load_latest(spark, f"{cfg.root.rstrip('/')}/models", f"{cfg.target.lower()}_model")
    pred = ev.apply_threshold(ml.score(model, data), cfg.scoring_threshold,
                              pred_col=f"PREDICTION_{cfg.target}")
    return save_table(pred, *_t(cfg, f"scoring_pred_{cfg.target.lower()}"))


def run_reporting(spark: SparkSession, results: dict[str, DataFrame], customers: DataFrame,
                  cfg: JobConfig) -> dict[str, DataFrame]:
    """Union fact of the models' results, report tiles and running measures,
    tile AUC, star join to the customer dimension."""
    fact = ev.union_model_results(results.items())
    fact = save_table(fact, *_t(cfg, "fact_train_all"))
    tiles = ev.report_tiles(fact)
    lift = save_table(ev.report_lift(tiles), *_t(cfg, "report_lift"))
    return {
        "fact": fact,
        "lift": lift,
        "auc": save_table(ev.report_auc(lift), *_t(cfg, "report_auc")),
        "scorecard": save_table(ev.model_scorecard(ev.confusion_counts(fact)), *_t(cfg, "report_scorecard")),
        "star": save_table(cu.fact_customer_star(fact, customers), *_t(cfg, "fact_customer_star")),
    }
