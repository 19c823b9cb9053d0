"""Model queries: oversampling, training + scoring, importances, versions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import cast_features, feature_columns, fill_missing_numeric
from ..operators import evaluate as ev
from ..operators import labels as lb
from ..operators import model as ml
from ..operators.assemble import feature_columns_in_order
from ..session import scratch_path, stage
from ..sources.fixtures import scored
from . import sqlgen as sg
from .catalog import register
from .catalog_assembly import (CHURN_WEIGHTS, CINEMA_WEIGHTS, SPORT_WEIGHTS, _HASH_SQL, _propensity_sql, _tables, _train_ctes,
                               training_set, training_set_of_all)
from ..operators import assemble as asm

FEATURES = feature_columns_in_order()
TARGET = "TARGET_CHURN"
TRAIN_THRESHOLD = 0.01     # threshold of the training report
SCORING_THRESHOLD = 0.16   # threshold of the scoring run


def model_frame(spark, sf_dir):
    """Labelled training set, -1 fill, features as double, hash split."""
    df = cast_features(fill_missing_numeric(training_set(spark, sf_dir, "CHURN")), FEATURES)
    return stage(lb.split_by_hash(df), "model-frame")


def _train_rows(df):
    return df.where(F.col("SPLIT") == "train").drop("SPLIT")


_FITTED = {}  # a model and its frame, by application and input files: the model keys share one fit


def _inputs(spark, sf_dir):
    """Number, newest time and bytes of the folder's files, so that a rewritten folder is fitted anew."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(sf_dir)
    return tuple(files.agg(F.count(F.lit(1)), F.max("modificationTime"), F.sum("length")).first())


def _once(spark, sf_dir, fit):
    key = (spark.sparkContext.applicationId, sf_dir, _inputs(spark, sf_dir), fit.__name__)
    if key not in _FITTED:
        _FITTED[key] = fit(spark, sf_dir)
    return _FITTED[key]


def _fit_churn(spark, sf_dir):
    df = model_frame(spark, sf_dir)
    train = _train_rows(df)
    balanced = ml.oversample_minority(train, FEATURES, TARGET).drop("SYNTHETIC")   # at most twice the rows
    return ml.train_gbt(balanced, FEATURES, TARGET, rows=2 * train.count()), df


def _fit(spark, sf_dir):
    return _once(spark, sf_dir, _fit_churn)


TARGETS = {m: f"TARGET_{m}" for m in lb.TARGET_EVENTS}
WEIGHTS = {"CHURN": CHURN_WEIGHTS, "SPORT": SPORT_WEIGHTS, "CINEMA": CINEMA_WEIGHTS}
GRADE_QUANTILE = 0.8   # rows of the top fifth of a month's propensity are the positives of the check of quality
AUC_FLOOR, LEAST_CLASS = 0.75, 5   # held-out AUC that every model must pass where both classes have as many rows


def _fit_requests(spark, sf_dir):
    """One model per target on the next month's requests, from one frame."""
    df = stage(lb.split_by_hash(cast_features(fill_missing_numeric(training_set_of_all(spark, sf_dir)), FEATURES)), "targets-frame")
    return ml.train_targets(_train_rows(df), FEATURES, list(TARGETS.values())), df


def _fit_propensity(spark, sf_dir):
    """One model per target on its propensity label (M9), which the features do explain."""
    df = cast_features(fill_missing_numeric(training_set(spark, sf_dir, "CHURN")), FEATURES).drop(TARGET)
    df = stage(lb.split_by_hash(df), "propensity-frame")
    for m, weights in WEIGHTS.items():
        label = lb.propensity_label(df, weights, GRADE_QUANTILE).select(*lb.KEYS, F.col("TARGET").alias(TARGETS[m]))
        df = df.join(label, lb.KEYS)
    df = stage(df, "propensity-targets")
    return ml.train_targets(_train_rows(df), FEATURES, list(TARGETS.values())), df


def _union_of_results(spark, sf_dir, fit):
    """U1 over the held-out rows, scored by each target's own model."""
    models, df = _once(spark, sf_dir, fit)
    test = df.where(F.col("SPLIT") == "test").drop("SPLIT")
    return ev.union_model_results(
        (m, ev.apply_threshold(ml.score(models[t], test), TRAIN_THRESHOLD, pred_col=f"PREDICTION_{m}")) for m, t in TARGETS.items())


# DuckDB parts: rows, keys and invariants of the model results (the scores
# themselves come out of a fit that SQL cannot express).
_SPLIT_CTES = _train_ctes() + [("parts", f"""select CUST_NUM, YEAR, MONTH, {TARGET},
    case when {_HASH_SQL} < 70 then 'train' else 'test' end as SPLIT from labelled""")]


def _checked(df, threshold):
    """The rows with the invariants of a scoring run in place of the score."""
    valid = F.col("y_proba").between(0, 1)
    agrees = F.col("PREDICTION_CHURN") == (F.col("y_proba") >= threshold).cast("int")
    return df.select("*", valid.alias("SCORE_VALID"), agrees.alias("PREDICTION_VALID"))


@register("oversample_minority", "M4")
def q_oversample_minority(spark, sf_dir):
    return ml.oversample_minority(_train_rows(model_frame(spark, sf_dir)), FEATURES, TARGET)


@register("oversample_counts", "M4", sg.render(_SPLIT_CTES + [
    ("tr", f"select {TARGET} as y from parts where SPLIT = 'train'"),
    ("c", "select count(*) filter (y = 0) as n0, count(*) filter (y = 1) as n1 from tr")], f"""
select y as {TARGET}, 0 as SYNTHETIC, count(*) as N from tr group by y
union all select 1, 1, n0 - n1 from c where n1 >= 2 and n0 > n1"""))
def q_oversample_counts(spark, sf_dir):
    """Rows of each class after balancing, real and synthetic."""
    return q_oversample_minority(spark, sf_dir).groupBy(TARGET, "SYNTHETIC").agg(F.count(F.lit(1)).alias("N"))


@register("train_and_score", "M5 M6 P15 P16 P17")
def q_train_and_score(spark, sf_dir):
    model, df = _fit(spark, sf_dir)
    test = df.where(F.col("SPLIT") == "test").drop("SPLIT")
    features = feature_columns(test, exclude=[TARGET])
    out = ev.apply_threshold(ml.score(model, test), TRAIN_THRESHOLD, pred_col="PREDICTION_CHURN")
    return out.select("CUST_NUM", "YEAR", "MONTH", TARGET, "PREDICTION_CHURN", "y_proba",
                      "THRESHOLD_USED", *features)


@register("scored_test_rows", "M5 M6 P15 P16 P17", sg.render(_SPLIT_CTES, f"""
select CUST_NUM, YEAR, MONTH, {TARGET}, cast({TRAIN_THRESHOLD} as double) as THRESHOLD_USED,
  true as SCORE_VALID, true as PREDICTION_VALID from parts where SPLIT = 'test'"""))
def q_scored_test_rows(spark, sf_dir):
    """Keys and invariants of ``train_and_score``."""
    return _checked(q_train_and_score(spark, sf_dir), TRAIN_THRESHOLD).select(
        "CUST_NUM", "YEAR", "MONTH", TARGET, "THRESHOLD_USED", "SCORE_VALID", "PREDICTION_VALID")


@register("feature_importance", "M7 O3")
def q_feature_importance(spark, sf_dir):
    model, _ = _fit(spark, sf_dir)
    pairs = ml.feature_importance(model, FEATURES)  # one value per feature
    return spark.createDataFrame(pairs, "feature string, gain double").orderBy(F.desc("gain"), "feature")


@register("feature_importance_rows", "M7 O3", "select unnest([" + ", ".join(f"'{c}'" for c in FEATURES)
          + "]) as feature, true as GAIN_VALID")
def q_feature_importance_rows(spark, sf_dir):
    """Features and invariants of ``feature_importance``."""
    return q_feature_importance(spark, sf_dir).select("feature", F.col("gain").between(0, 1).alias("GAIN_VALID"))


@register("feature_gains", "M7 O3")
def q_feature_gains(spark, sf_dir):
    """Average gain of each feature's splits from the model's node table, highest first."""
    model, _ = _fit(spark, sf_dir)
    place = F.row_number().over(Window.orderBy(F.desc("gain"), "feature"))   # one row per feature
    return ml.split_gains(spark, model, FEATURES).withColumn("place", place)


@register("feature_gain_rows", "M7 O3", "select unnest([" + ", ".join(f"'{c}'" for c in FEATURES)
          + "]) as feature, true as ZERO_IF_UNUSED, true as IMPORTANCE_MATCHES, true as ORDER_VALID")
def q_feature_gain_rows(spark, sf_dir):
    """The chosen features; weighted gains add up to Spark's own importances, unused ones have 0, places follow the gain."""
    model, _ = _fit(spark, sf_dir)
    own = spark.createDataFrame(ml.feature_importance(model, FEATURES), "feature string, spark_importance double")
    before = F.lag("gain").over(Window.orderBy("place"))
    return q_feature_gains(spark, sf_dir).withColumn("_before", before).join(own, "feature").select(
        "feature", ((F.col("n_splits") > 0) | ((F.col("gain") == 0) & (F.col("importance") == 0))).alias("ZERO_IF_UNUSED"),
        (F.abs(F.col("importance") - F.col("spark_importance")) < 1e-9).alias("IMPORTANCE_MATCHES"),
        (F.col("_before").isNull() | (F.col("_before") >= F.col("gain"))).alias("ORDER_VALID"))


@register("score_latest_model", "M8 J7 M6 P16")
def q_score_latest_model(spark, sf_dir):
    """Register the fitted model as a version, load the latest version back and
    score the scoring-window dataset with the scoring threshold."""
    root = scratch_path(spark, "models")
    model, _ = _fit(spark, sf_dir)
    ml.register_model(spark, model, root, "churn_model")
    latest = ml.load_latest(spark, root, "churn_model")
    t = _tables(spark, sf_dir, "score")
    scoring = asm.assemble(t.tv, t.internet, t.mobile, t.socio, t.journeys)
    scoring = cast_features(fill_missing_numeric(scoring), FEATURES)
    return ev.apply_threshold(ml.score(latest, scoring), SCORING_THRESHOLD, pred_col="PREDICTION_CHURN")


@register("scored_latest_rows", "M8 J7 M6 P16", sg.render(
    sg.feature_set_ctes("score") + [("assembled", sg.assembled_select(False))], f"""
select CUST_NUM, YEAR, MONTH, cast({SCORING_THRESHOLD} as double) as THRESHOLD_USED,
  true as SCORE_VALID, true as PREDICTION_VALID from assembled"""))
def q_scored_latest_rows(spark, sf_dir):
    """Keys and invariants of ``score_latest_model``."""
    return _checked(q_score_latest_model(spark, sf_dir), SCORING_THRESHOLD).select(
        "CUST_NUM", "YEAR", "MONTH", "THRESHOLD_USED", "SCORE_VALID", "PREDICTION_VALID")


def _registry(spark, sf_dir):
    """One version per model and training month of the scored results."""
    months = scored(spark, sf_dir).select("MODEL_TYPE", "YEAR", "MONTH").distinct()
    w = Window.partitionBy("MODEL_TYPE").orderBy("YEAR", "MONTH")
    name = F.concat(F.lower("MODEL_TYPE"), F.lit("_model"))
    return months.select(name.alias("model_name"), F.dense_rank().over(w).cast("long").alias("version")) \
        .withColumn("path", F.concat(F.lit("models/"), F.col("model_name"), F.lit("/v"), F.col("version").cast("string")))


@register("latest_model_version", "M8", sg.render(sg.fixture_ctes("scored") + [
    ("reg", """select lower(MODEL_TYPE) || '_model' as model_name,
        dense_rank() over (partition by MODEL_TYPE order by YEAR, MONTH) as version
      from (select distinct MODEL_TYPE, YEAR, MONTH from scored)""")], """
select model_name, max(version) as version,
  'models/' || model_name || '/v' || cast(max(version) as varchar) as path, 'last' as alias
from reg group by model_name"""))
def q_latest_model_version(spark, sf_dir):
    return ml.latest_versions(_registry(spark, sf_dir))


# ---------------------------------------------------------------------------- three targets


@register("trained_union_fact", "M5 M6 U1 P18 P19")
def q_trained_union_fact(spark, sf_dir):
    """The union fact of the churn, sport and cinema models' own held-out results."""
    return _union_of_results(spark, sf_dir, _fit_requests)


def _union_rows_sql() -> str:
    ctes = _train_ctes()
    known = {name for name, _ in ctes}
    ctes += [c for m in TARGETS for c in _train_ctes(m) if c[0] == f"tg_{m}" and c[0] not in known]
    rows = "\nunion all\n".join(f"""select a.CUST_NUM, a.YEAR, a.MONTH, cast(coalesce(t.{col}, 0) as integer) as TARGET, '{m}' as MODEL_TYPE
      from assembled a left join tg_{m} t on a.CUST_NUM = t.CUST_NUM and a.YEAR = t.YEAR and a.MONTH = t.MONTH
      where {_HASH_SQL.replace("CUST_NUM", "a.CUST_NUM")} >= 70""" for m, col in TARGETS.items())
    return sg.render(ctes, f"""select *, cast({TRAIN_THRESHOLD} as double) as THRESHOLD_USED,
      true as SCORE_VALID, true as PREDICTION_VALID from ({rows})""")


@register("trained_union_rows", "M5 M6 U1 P18 P19", _union_rows_sql())
def q_trained_union_rows(spark, sf_dir):
    """Keys, targets and invariants of ``trained_union_fact``."""
    df = q_trained_union_fact(spark, sf_dir)
    return df.select("CUST_NUM", "YEAR", "MONTH", F.col("TARGET").cast("int").alias("TARGET"), "MODEL_TYPE", "THRESHOLD_USED",
                     F.col("y_proba").between(0, 1).alias("SCORE_VALID"),
                     (F.col("PREDICTION") == (F.col("y_proba") >= TRAIN_THRESHOLD).cast("int")).alias("PREDICTION_VALID"))


@register("trained_model_auc", "M5 M6 U1 E5", "\nunion all\n".join(f"""
select '{m}' as MODEL_TYPE, count(*) filter (TARGET = 1) as POSITIVES, count(*) filter (TARGET = 0) as NEGATIVES, true as AUC_ABOVE_FLOOR
from ({_propensity_sql(w, GRADE_QUANTILE)}) where {_HASH_SQL} >= 70""" for m, w in WEIGHTS.items()))
def q_trained_model_auc(spark, sf_dir):
    """Held-out AUC of the three models on labels that the features explain; a constant model (AUC 0.5) fails the floor.
    Where a class has fewer than LEAST_CLASS held-out rows, the AUC says nothing and isn't held against it."""
    auc = ev.roc_auc(_union_of_results(spark, sf_dir, _fit_propensity))
    few = F.least("POSITIVES", "NEGATIVES") < LEAST_CLASS
    return auc.select("MODEL_TYPE", "POSITIVES", "NEGATIVES", (few | (F.col("AUC") >= AUC_FLOOR)).alias("AUC_ABOVE_FLOOR"))
