"""Evaluation queries over the deterministic scored fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..sources.fixtures import MODEL_TYPES, scored
from . import sqlgen as sg
from .catalog import register

SCORING_THRESHOLD = 0.16
SLICE = ["CHURN", "SPORT"]


def thresholded(spark, sf_dir):
    return ev.apply_threshold(scored(spark, sf_dir), SCORING_THRESHOLD)


def union_fact(spark, sf_dir):
    """Three per-model result tables (TARGET_<M>, PREDICTION_<M>) unioned."""
    t = thresholded(spark, sf_dir)
    parts = []
    for m in MODEL_TYPES:
        part = (t.where(F.col("MODEL_TYPE") == m).drop("MODEL_TYPE")
                 .withColumnRenamed("TARGET", f"TARGET_{m}")
                 .withColumnRenamed("PREDICTION", f"PREDICTION_{m}"))
        parts.append((m, part))
    return ev.union_model_results(parts)


# ---------------------------------------------------------------------------- DuckDB parts

_THR = ("thr", f"""select ROW_ID, CUST_NUM, YEAR, MONTH, MODEL_TYPE, TARGET,
    cast(y_proba >= {SCORING_THRESHOLD} as integer) as PREDICTION, y_proba,
    cast({SCORING_THRESHOLD} as double) as THRESHOLD_USED from scored""")
_BASE = sg.fixture_ctes("scored") + [_THR]
_UNION = ("fact", "\nunion all\n".join(
    f"""select CUST_NUM, YEAR, MONTH, TARGET, PREDICTION, y_proba, THRESHOLD_USED,
        '{m}' as MODEL_TYPE from thr where MODEL_TYPE = '{m}'""" for m in MODEL_TYPES))
_CM = ("cm", """select MODEL_TYPE,
    cast(sum(case when TARGET = 1 and PREDICTION = 1 then 1 else 0 end) as bigint) as TP,
    cast(sum(case when TARGET = 0 and PREDICTION = 1 then 1 else 0 end) as bigint) as FP,
    cast(sum(case when TARGET = 1 and PREDICTION = 0 then 1 else 0 end) as bigint) as FN,
    cast(sum(case when TARGET = 0 and PREDICTION = 0 then 1 else 0 end) as bigint) as TN
  from thr group by MODEL_TYPE""")


def _div(a: str, b: str, alt: str | None = None) -> str:
    q = f"(case when ({b}) <> 0 then cast(({a}) as double) / cast(({b}) as double) end)"
    return q if alt is None else f"coalesce({q}, {alt})"


def sql(body: str, *extra: sg.Cte) -> str:
    return sg.render(_BASE + list(extra), body)


# ---------------------------------------------------------------------------- P16, P17, O1, U1, P20


@register("apply_threshold", "P16 P17", sql("select * from thr"))
def q_apply_threshold(spark, sf_dir):
    return thresholded(spark, sf_dir)


@register("scored_ordered", "O1", sql("select * from thr order by y_proba desc"))
def q_scored_ordered(spark, sf_dir):
    return ev.scored_ordered(thresholded(spark, sf_dir), key_cols=["ROW_ID"])


@register("union_model_results", "U1 P18 P19", sql("select * from fact", _UNION))
def q_union_model_results(spark, sf_dir):
    return union_fact(spark, sf_dir)


@register("report_slice", "P20", sql(
    "select * from fact where MODEL_TYPE in (" + ", ".join(f"'{m}'" for m in SLICE) + ")", _UNION))
def q_report_slice(spark, sf_dir):
    return ev.report_slice(union_fact(spark, sf_dir), SLICE)


# ---------------------------------------------------------------------------- E1-E5, A10, A11


@register("confusion_counts", "E1", sql("select * from cm", _CM))
def q_confusion_counts(spark, sf_dir):
    return ev.confusion_counts(thresholded(spark, sf_dir))


@register("model_scorecard", "E3", sql(f"""
select *, 2.0 * {_div('Precision * Recall', 'Precision + Recall')} as F1 from (
  select *, {_div('TP', 'TP + FN')} as Recall, {_div('TP', 'TP + FP')} as Precision,
         {_div('FP', 'FP + TN')} as FPR, {_div('TP + TN', 'TP + TN + FP + FN', '0.0')} as Accuracy
  from cm)""", _CM))
def q_model_scorecard(spark, sf_dir):
    return ev.model_scorecard(ev.confusion_counts(thresholded(spark, sf_dir)))


def _cls_sql() -> str:
    z = "0.0"
    b = f"""select MODEL_TYPE,
        {_div('TN', 'TN + FN', z)} as p0, {_div('TN', 'TN + FP', z)} as r0,
        {_div('2 * TN', '2 * TN + FN + FP', z)} as f0, TN + FP as s0,
        {_div('TP', 'TP + FP', z)} as p1, {_div('TP', 'TP + FN', z)} as r1,
        {_div('2 * TP', '2 * TP + FP + FN', z)} as f1, TP + FN as s1,
        {_div('TP + TN', 'TP + FP + FN + TN', z)} as acc, TP + FP + FN + TN as n
      from cm"""
    w = lambda a, c: _div(f"{a} * s0 + {c} * s1", "n")
    body = f"""
select MODEL_TYPE, '0' as CLASS, p0 as precision, r0 as recall, f0 as f1_score, s0 as support from b
union all select MODEL_TYPE, '1', p1, r1, f1, s1 from b
union all select MODEL_TYPE, 'accuracy', cast(null as double), cast(null as double), acc, n from b
union all select MODEL_TYPE, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n from b
union all select MODEL_TYPE, 'weighted avg', {w('p0', 'p1')}, {w('r0', 'r1')}, {w('f0', 'f1')}, n from b"""
    return sql(body, _CM, ("b", b))


@register("classification_report", "E2", _cls_sql())
def q_classification_report(spark, sf_dir):
    return ev.classification_report(ev.confusion_counts(thresholded(spark, sf_dir)))


def _sweep_sql() -> str:
    grid = ("grid", f"""select cast({ev.SWEEP_START} as double) + cast(i as double) * cast({ev.SWEEP_STEP} as double) as th,
        round(cast({ev.SWEEP_START} as double) + cast(i as double) * cast({ev.SWEEP_STEP} as double), 2) as threshold
      from range({ev.SWEEP_POINTS}) t(i)""")
    cnt = ("cnt", """select s.MODEL_TYPE, g.threshold,
        cast(sum(case when s.y_proba >= g.th and s.TARGET = 1 then 1 else 0 end) as bigint) as TP,
        cast(sum(case when s.y_proba >= g.th and s.TARGET = 0 then 1 else 0 end) as bigint) as FP,
        cast(sum(case when s.TARGET = 1 then 1 else 0 end) as bigint) as P,
        cast(sum(case when s.TARGET = 0 then 1 else 0 end) as bigint) as N
      from scored s, grid g group by s.MODEL_TYPE, g.threshold""")
    z = "0.0"
    body = f"""
select MODEL_TYPE, threshold,
  round({_div('TP', 'TP + FP', z)}, 4) as precision,
  round({_div('TP', 'P', z)}, 4) as recall,
  round({_div('2 * TP', '2 * TP + FP + (P - TP)', z)}, 4) as f1,
  round({_div('TP + (N - FP)', 'P + N', z)}, 4) as accuracy,
  TP, FP, N - FP as TN, P - TP as FN
from cnt"""
    return sql(body, grid, cnt)


@register("threshold_sweep", "E4 J13", _sweep_sql())
def q_threshold_sweep(spark, sf_dir):
    return ev.threshold_sweep(scored(spark, sf_dir))


@register("roc_auc", "E5", sql("""
select MODEL_TYPE, case when sum(pos) * sum(neg) > 0
    then sum(cast(pos as double) * (cast(nb as double) + cast(neg as double) / 2))
         / (cast(sum(pos) as double) * cast(sum(neg) as double)) end as AUC,
  cast(sum(pos) as bigint) as POSITIVES, cast(sum(neg) as bigint) as NEGATIVES
from (select *, coalesce(sum(neg) over (partition by MODEL_TYPE order by y_proba
        rows between unbounded preceding and 1 preceding), 0) as nb
      from (select MODEL_TYPE, y_proba, sum(case when TARGET = 1 then 1 else 0 end) as pos,
                   sum(case when TARGET = 0 then 1 else 0 end) as neg
            from scored group by MODEL_TYPE, y_proba))
group by MODEL_TYPE"""))
def q_roc_auc(spark, sf_dir):
    return ev.roc_auc(scored(spark, sf_dir))


@register("class_distribution", "A10", sql(
    "select MODEL_TYPE, TARGET, count(*) as COUNT from scored group by MODEL_TYPE, TARGET"))
def q_class_distribution(spark, sf_dir):
    return ev.class_distribution(scored(spark, sf_dir))


@register("captured_positives", "A11", sql("""
select MODEL_TYPE, cast(sum(TARGET) as bigint) as SUM_TARGET, cast(sum(PREDICTION) as bigint) as SUM_PREDICTION
from thr where TARGET = 1 group by MODEL_TYPE"""))
def q_captured_positives(spark, sf_dir):
    return ev.captured_positives(thresholded(spark, sf_dir))


# ---------------------------------------------------------------------------- W2, W3

_TILES = ("tiles", """select ROW_ID, CUST_NUM, YEAR, MONTH, MODEL_TYPE, TARGET, y_proba,
    cast(case when rn = 1 then 1 else least(20, (20 * (rn - 1) + n - 2) // greatest(n - 1, 1)) end as integer) as TILE
  from (select *, row_number() over (partition by MODEL_TYPE order by y_proba desc, ROW_ID) as rn,
               count(*) over (partition by MODEL_TYPE) as n from scored)""")


@register("score_tiles", "W2", sql("select * from tiles", _TILES))
def q_score_tiles(spark, sf_dir):
    return ev.score_tiles(scored(spark, sf_dir))


def _lift_sql() -> str:
    seg = ("seg", """select MODEL_TYPE, TILE, cast(sum(TARGET) as bigint) as segment_target,
        count(*) as segment_total from tiles group by MODEL_TYPE, TILE""")
    run = ("run", """select *, cast(sum(segment_target) over w as bigint) as running_target,
        cast(sum(segment_total) over w as bigint) as running_total,
        sum(segment_target) over (partition by MODEL_TYPE) as pos,
        sum(segment_total) over (partition by MODEL_TYPE) as alln
      from seg window w as (partition by MODEL_TYPE order by TILE rows between unbounded preceding and current row)""")
    pr = ("pr", f"""select *, {_div('running_target', 'running_total')} as running_precision,
        {_div('running_target', 'pos')} as running_recall, {_div('pos', 'alln')} as base from run""")
    body = f"""
select MODEL_TYPE, TILE, segment_target, segment_total, running_target, running_total,
  running_precision, running_recall, {_div('running_precision', 'base')} as running_lift,
  {_div('2 * (running_precision * running_recall)', 'running_precision + running_recall + 1e-9')} as running_f1score
from pr order by MODEL_TYPE, TILE"""
    return sql(body, _TILES, seg, run, pr)


@register("lift_table", "W3 O2", _lift_sql())
def q_lift_table(spark, sf_dir):
    return ev.lift_table(ev.score_tiles(scored(spark, sf_dir)))


# ---------------------------------------------------------------------------- W4-W7

_RANKED = ("ranked", """select *, rank() over (partition by MODEL_TYPE order by y_proba desc) as Rank_Proba,
    count(*) over (partition by MODEL_TYPE) as n from fact_r""")
_FACT_R = ("fact_r", "select ROW_ID, CUST_NUM, YEAR, MONTH, MODEL_TYPE, TARGET, PREDICTION, y_proba from thr")
_DECILE = ("dec", "select * exclude (n), ((Rank_Proba - 1) * 20) // n + 1 as Decile from ranked")


def _fact_r(spark, sf_dir):
    return thresholded(spark, sf_dir).drop("THRESHOLD_USED")


@register("model_rank", "W4", sql("select * exclude (n) from ranked", _FACT_R, _RANKED))
def q_model_rank(spark, sf_dir):
    return ev.model_rank(_fact_r(spark, sf_dir))


@register("report_tiles", "W5", sql("select * from dec", _FACT_R, _RANKED, _DECILE))
def q_report_tiles(spark, sf_dir):
    return ev.report_tiles(_fact_r(spark, sf_dir))


def _report_lift_ctes() -> list[sg.Cte]:
    seg = ("rseg", """select MODEL_TYPE, Decile, cast(sum(TARGET) as bigint) as Segment_Target,
        count(*) as Segment_Total, cast(sum(case when TARGET = 0 then 1 else 0 end) as bigint) as neg
      from dec group by MODEL_TYPE, Decile""")
    run = ("rrun", """select MODEL_TYPE, Decile, Segment_Target, Segment_Total,
        cast(sum(Segment_Target) over w as bigint) as Running_Target,
        cast(sum(Segment_Total) over w as bigint) as Running_Total,
        cast(sum(neg) over w as bigint) as Running_FP,
        cast(sum(neg) over (partition by MODEL_TYPE) as bigint) as Total_Negatives,
        sum(Segment_Target) over (partition by MODEL_TYPE) as pos,
        sum(Segment_Total) over (partition by MODEL_TYPE) as alln
      from rseg window w as (partition by MODEL_TYPE order by Decile rows between unbounded preceding and current row)""")
    pr = ("rpr", f"""select * exclude (pos, alln),
        {_div('Running_Target', 'Running_Total', '0.0')} as Running_Precision,
        {_div('Running_Target', 'pos', '0.0')} as Running_Recall,
        {_div('pos', 'alln')} as Baseline,
        {_div('Running_FP', 'Total_Negatives', '0.0')} as Running_FPR from rrun""")
    out = ("rlift", f"""select *, {_div('Running_Precision', 'Baseline', '0.0')} as Running_Lift,
        {_div('2 * Running_Precision * Running_Recall', 'Running_Precision + Running_Recall', '0.0')} as Running_F1Score
      from rpr""")
    return [_FACT_R, _RANKED, _DECILE, seg, run, pr, out]


@register("report_lift", "W6", sql("select * from rlift", *_report_lift_ctes()))
def q_report_lift(spark, sf_dir):
    return ev.report_lift(ev.report_tiles(_fact_r(spark, sf_dir)))


@register("report_auc", "W7", sql("""
select MODEL_TYPE, round(sum(a), 9) as AUC from (
  select MODEL_TYPE, case when lead(Running_FPR) over w is not null
      then (lead(Running_FPR) over w - Running_FPR) * (Running_Recall + lead(Running_Recall) over w) / 2
      else 0.0 end as a
  from rlift window w as (partition by MODEL_TYPE order by Decile))
group by MODEL_TYPE""", *_report_lift_ctes()))
def q_report_auc(spark, sf_dir):
    auc = ev.report_auc(ev.report_lift(ev.report_tiles(_fact_r(spark, sf_dir))))
    return auc.select("MODEL_TYPE", F.round("AUC", 9).alias("AUC"))  # order-free digits only
