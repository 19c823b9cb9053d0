"""Model evaluation as Spark aggregates.

Only the per-row steps (threshold, rank, tile) touch the scored rows; every
metric is then computed on a table of at most (models x tiles) or
(models x distinct scores) rows. Ranks and tiles inside a model use the
range-partitioned ranking of ``functions.ranking``, so a model holding a
third of all rows is still spread over many tasks.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import safe_div
from ..functions.ranking import prefix_sums, with_competition_rank, with_row_number

MODEL = "MODEL_TYPE"
N_TILES = 20


# ---------------------------------------------------------------------------- P16-P20, U1


def apply_threshold(df: DataFrame, threshold: float, score_col: str = "y_proba",
                    pred_col: str = "PREDICTION") -> DataFrame:
    """P16 + P17: 0/1 prediction at ``threshold`` and the threshold as a column."""
    return (df.withColumn(pred_col, (F.col(score_col) >= F.lit(threshold)).cast("int"))
              .withColumn("THRESHOLD_USED", F.lit(float(threshold))))


def tag_model(df: DataFrame, model: str) -> DataFrame:
    """Common names TARGET / PREDICTION and a MODEL_TYPE column."""
    m = model.upper()
    return (df.withColumnRenamed(f"TARGET_{m}", "TARGET")
              .withColumnRenamed(f"PREDICTION_{m}", "PREDICTION")
              .withColumn(MODEL, F.lit(m)))


# Columns of the union fact.
UNION_COLUMNS = ["CUST_NUM", "YEAR", "MONTH", "TARGET", "PREDICTION", "y_proba", "THRESHOLD_USED", MODEL]


def union_model_results(results: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """U1 (+P18, P19): one fact of all models' results, features dropped."""
    tagged = [tag_model(df, m).select(*UNION_COLUMNS) for m, df in results]
    return reduce(DataFrame.unionByName, tagged)


def report_slice(df: DataFrame, models: Sequence[str]) -> DataFrame:
    """P20: the report's model slicer."""
    return df.where(F.col(MODEL).isin(list(models)))


# ---------------------------------------------------------------------------- E1-E3


def _cnt(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def confusion_counts(df: DataFrame, group_cols: Sequence[str] = (MODEL,), target: str = "TARGET",
                     pred: str = "PREDICTION") -> DataFrame:
    """TP/FP/FN/TN per group in one aggregate."""
    t, p = F.col(target), F.col(pred)
    return df.groupBy(*group_cols).agg(
        _cnt((t == 1) & (p == 1)).alias("TP"), _cnt((t == 0) & (p == 1)).alias("FP"),
        _cnt((t == 1) & (p == 0)).alias("FN"), _cnt((t == 0) & (p == 0)).alias("TN"))


def model_scorecard(cm: DataFrame) -> DataFrame:
    """Recall, Precision, FPR, F1 (null on a zero denominator) and
    Accuracy (0 on a zero denominator) from confusion counts."""
    tp, fp, fn, tn = (F.col(c) for c in ("TP", "FP", "FN", "TN"))
    recall = safe_div(tp, tp + fn)
    precision = safe_div(tp, tp + fp)
    out = cm.select("*", recall.alias("Recall"), precision.alias("Precision"),
                    safe_div(fp, fp + tn).alias("FPR"),
                    safe_div(tp + tn, tp + tn + fp + fn, 0.0).alias("Accuracy"))
    f1 = F.lit(2.0) * safe_div(F.col("Precision") * F.col("Recall"), F.col("Precision") + F.col("Recall"))
    return out.withColumn("F1", f1)


def classification_report(cm: DataFrame, group_cols: Sequence[str] = (MODEL,)) -> DataFrame:
    """Per class precision / recall / f1 / support, then accuracy, macro
    and weighted averages (zero division → 0), from confusion counts."""
    tp, fp, fn, tn = (F.col(c) for c in ("TP", "FP", "FN", "TN"))
    n = tp + fp + fn + tn
    # class 1: (tp, fp, fn); class 0 swaps roles: its tp is tn, fp is fn, fn is fp.
    def cls(t, f_p, f_n):
        p = F.coalesce(safe_div(t, t + f_p), F.lit(0.0))
        r = F.coalesce(safe_div(t, t + f_n), F.lit(0.0))
        f1 = F.coalesce(safe_div(2 * t, 2 * t + f_p + f_n), F.lit(0.0))
        return p, r, f1, (t + f_n)
    p1, r1, f11, s1 = cls(tp, fp, fn)
    p0, r0, f10, s0 = cls(tn, fn, fp)
    g = list(group_cols)
    base = cm.select(*g, p0.alias("p0"), r0.alias("r0"), f10.alias("f0"), s0.alias("s0"),
                     p1.alias("p1"), r1.alias("r1"), f11.alias("f1"), s1.alias("s1"),
                     F.coalesce(safe_div(tp + tn, n), F.lit(0.0)).alias("acc"), n.alias("n"))
    w = lambda a, b: safe_div(F.col(a) * F.col("s0") + F.col(b) * F.col("s1"), F.col("n"))
    def row(label, p, r, f, sup):
        return F.struct(F.lit(label).alias("CLASS"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1_score"),
                        sup.cast("long").alias("support"))
    c = F.col
    none = F.lit(None).cast("double")
    rows = F.array(
        row("0", c("p0"), c("r0"), c("f0"), c("s0")),
        row("1", c("p1"), c("r1"), c("f1"), c("s1")),
        row("accuracy", none, none, c("acc"), c("n")),
        row("macro avg", (c("p0") + c("p1")) / 2, (c("r0") + c("r1")) / 2, (c("f0") + c("f1")) / 2, c("n")),
        row("weighted avg", w("p0", "p1"), w("r0", "r1"), w("f0", "f1"), c("n")))
    return base.select(*g, F.inline(rows))


# ---------------------------------------------------------------------------- E4

# The sweep grid is numpy ``arange(0.01, 0.91, 0.05)`` (18
# points, computed as start + i * step), labelled rounded to 2 decimals.
SWEEP_START, SWEEP_STEP, SWEEP_POINTS = 0.01, 0.05, 18


def sweep_grid() -> list[float]:
    return [SWEEP_START + i * SWEEP_STEP for i in range(SWEEP_POINTS)]


def threshold_sweep(df: DataFrame, thresholds: Sequence[float] | None = None,
                    group_cols: Sequence[str] = (MODEL,), score_col: str = "y_proba",
                    target: str = "TARGET") -> DataFrame:
    """Counts and rounded metrics at each threshold, one pass over the
    rows (two conditional sums per threshold), then unpacked into one row per
    threshold. No grid x rows join."""
    ths = list(thresholds or sweep_grid())
    s, t = F.col(score_col), F.col(target)
    aggs = [_cnt(t == 1).alias("P"), _cnt(t == 0).alias("N")]
    for i, th in enumerate(ths):
        aggs += [_cnt((s >= F.lit(th)) & (t == 1)).alias(f"tp{i}"),
                 _cnt((s >= F.lit(th)) & (t == 0)).alias(f"fp{i}")]
    wide = df.groupBy(*group_cols).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(round(th, 2)).alias("threshold"), F.col(f"tp{i}").alias("TP"),
                              F.col(f"fp{i}").alias("FP")) for i, th in enumerate(ths)])
    long = wide.select(*group_cols, "P", "N", F.inline(rows))
    tp, fp = F.col("TP"), F.col("FP")
    fn, tn = F.col("P") - tp, F.col("N") - fp
    z = F.lit(0.0)
    return long.select(
        *group_cols, "threshold",
        F.round(F.coalesce(safe_div(tp, tp + fp), z), 4).alias("precision"),
        F.round(F.coalesce(safe_div(tp, tp + fn), z), 4).alias("recall"),
        F.round(F.coalesce(safe_div(2 * tp, 2 * tp + fp + fn), z), 4).alias("f1"),
        F.round(F.coalesce(safe_div(tp + tn, F.col("P") + F.col("N")), z), 4).alias("accuracy"),
        tp.alias("TP"), fp.alias("FP"), tn.alias("TN"), fn.alias("FN"))


# ---------------------------------------------------------------------------- E5


def roc_auc(df: DataFrame, group_cols: Sequence[str] = (MODEL,), score_col: str = "y_proba",
            target: str = "TARGET") -> DataFrame:
    """E5: exact ROC AUC with tied scores counted half (Mann-Whitney U).

    Rows collapse to (group, distinct score, positives, negatives); a
    distributed running sum of negatives below each score gives
    AUC = sum(pos * (neg_below + neg / 2)) / (P * N). Null when a group has
    no positives or no negatives.
    """
    g = list(group_cols)
    per = df.groupBy(*g, score_col).agg(_cnt(F.col(target) == 1).alias("pos"),
                                       _cnt(F.col(target) == 0).alias("neg"))
    ps = prefix_sums(per, g, [(score_col, True)], ["neg", "pos"])
    contrib = F.col("pos").cast("double") * (F.col("neg_before").cast("double") + F.col("neg").cast("double") / 2)
    agg = ps.groupBy(*g).agg(F.sum(contrib).alias("_u"), F.first("pos_total").alias("P"),
                             F.first("neg_total").alias("N"))
    return agg.select(*g, safe_div(F.col("_u"), F.col("P").cast("double") * F.col("N")).alias("AUC"),
                      F.col("P").cast("long").alias("POSITIVES"), F.col("N").cast("long").alias("NEGATIVES"))


# ---------------------------------------------------------------------------- W2, W3


def score_tiles(df: DataFrame, group_cols: Sequence[str] = (MODEL,), score_col: str = "y_proba",
                tie_col: str | Sequence[str] = "ROW_ID", n_tiles: int = N_TILES, out_col: str = "TILE") -> DataFrame:
    """Equal-count tiles over rows sorted by score descending (ties
    broken by ``tie_col``), quantile cut of the row position:
    tile = max(1, ceil(n_tiles * i / (n - 1))) for 0-based position i."""
    ties = [tie_col] if isinstance(tie_col, str) else tie_col
    rn = with_row_number(df, group_cols, [(score_col, False), *((c, True) for c in ties)], "_rn", "_n")
    # integer ceil(n_tiles * i / (n - 1)) = (n_tiles * i + n - 2) div (n - 1), i = rn - 1
    tile = F.expr(f"case when _rn = 1 then 1 else ({n_tiles} * (_rn - 1) + _n - 2) div greatest(_n - 1, 1) end")
    return rn.withColumn(out_col, F.least(tile, F.lit(n_tiles)).cast("int")).drop("_rn", "_n")


def lift_table(tiles: DataFrame, group_cols: Sequence[str] = (MODEL,), tile_col: str = "TILE",
               target: str = "TARGET") -> DataFrame:
    """Per tile positives and size, running sums, running precision,
    recall, lift and F1 (1e-9 in the F1 denominator), tile ascending."""
    g = list(group_cols)
    seg = tiles.groupBy(*g, tile_col).agg(F.sum(target).cast("long").alias("segment_target"),
                                          F.count(F.lit(1)).alias("segment_total"))
    run = Window.partitionBy(*g).orderBy(tile_col).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*g)
    out = seg.select(*g, tile_col, "segment_target", "segment_total",
                     F.sum("segment_target").over(run).alias("running_target"),
                     F.sum("segment_total").over(run).alias("running_total"),
                     F.sum("segment_target").over(whole).alias("_pos"),
                     F.sum("segment_total").over(whole).alias("_all"))
    prec = safe_div(F.col("running_target"), F.col("running_total"))
    rec = safe_div(F.col("running_target"), F.col("_pos"))
    base = safe_div(F.col("_pos"), F.col("_all"))
    out = out.select("*", prec.alias("running_precision"), rec.alias("running_recall"),
                     base.alias("_base"))
    f1 = safe_div(2 * (F.col("running_precision") * F.col("running_recall")),
                  F.col("running_precision") + F.col("running_recall") + F.lit(1e-9))
    return (out.withColumn("running_lift", safe_div(F.col("running_precision"), F.col("_base")))
               .withColumn("running_f1score", f1)
               .drop("_pos", "_all", "_base")
               .orderBy(*g, tile_col))


# ---------------------------------------------------------------------------- W4-W7


def model_rank(df: DataFrame, group_cols: Sequence[str] = (MODEL,), score_col: str = "y_proba",
               out_col: str = "Rank_Proba", count_col: str | None = None) -> DataFrame:
    """Competition rank by score descending inside each model (ties share,
    next rank skips)."""
    return with_competition_rank(df, group_cols, score_col, False, out_col, count_col)


def report_tiles(df: DataFrame, group_cols: Sequence[str] = (MODEL,), score_col: str = "y_proba",
                 n_tiles: int = N_TILES, out_col: str = "Decile") -> DataFrame:
    """The report's tile INT((rank - 1) * 20 / N) + 1 over the competition rank."""
    ranked = model_rank(df, group_cols, score_col, "Rank_Proba", "_n")
    tile = F.expr(f"((Rank_Proba - 1) * {n_tiles}) div _n + 1")
    return ranked.withColumn(out_col, tile.cast("long")).drop("_n")


def report_lift(tiles: DataFrame, group_cols: Sequence[str] = (MODEL,), tile_col: str = "Decile",
                target: str = "TARGET") -> DataFrame:
    """The report's running measures per model and tile."""
    g = list(group_cols)
    seg = tiles.groupBy(*g, tile_col).agg(
        F.sum(target).cast("long").alias("Segment_Target"),
        F.count(F.lit(1)).alias("Segment_Total"),
        _cnt(F.col(target) == 0).alias("_neg"))
    run = Window.partitionBy(*g).orderBy(tile_col).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*g)
    s = seg.select(*g, tile_col, "Segment_Target", "Segment_Total",
                   F.sum("Segment_Target").over(run).alias("Running_Target"),
                   F.sum("Segment_Total").over(run).alias("Running_Total"),
                   F.sum("_neg").over(run).alias("Running_FP"),
                   F.sum("_neg").over(whole).alias("Total_Negatives"),
                   F.sum("Segment_Target").over(whole).alias("_pos"),
                   F.sum("Segment_Total").over(whole).alias("_all"))
    s = s.select("*", safe_div(F.col("Running_Target"), F.col("Running_Total"), 0.0).alias("Running_Precision"),
                 safe_div(F.col("Running_Target"), F.col("_pos"), 0.0).alias("Running_Recall"),
                 safe_div(F.col("_pos"), F.col("_all")).alias("Baseline"),
                 safe_div(F.col("Running_FP"), F.col("Total_Negatives"), 0.0).alias("Running_FPR"))
    p, r = F.col("Running_Precision"), F.col("Running_Recall")
    return (s.withColumn("Running_Lift", safe_div(p, F.col("Baseline"), 0.0))
             .withColumn("Running_F1Score", safe_div(2 * p * r, p + r, 0.0))
             .drop("_pos", "_all"))


def report_auc(lift: DataFrame, group_cols: Sequence[str] = (MODEL,), tile_col: str = "Decile") -> DataFrame:
    """Trapezoids between consecutive tile points (FPR, TPR); the curve
    starts at the first tile, not at (0, 0), as in the report."""
    g = list(group_cols)
    w = Window.partitionBy(*g).orderBy(tile_col)
    x2, y2 = F.lead("Running_FPR").over(w), F.lead("Running_Recall").over(w)
    seg = lift.select(*g, F.when(x2.isNotNull(), (x2 - F.col("Running_FPR")) *
                                 (F.col("Running_Recall") + y2) / 2).otherwise(F.lit(0.0)).alias("_a"))
    return seg.groupBy(*g).agg(F.sum("_a").alias("AUC"))


# ---------------------------------------------------------------------------- A10, A11, O1


def class_distribution(df: DataFrame, group_cols: Sequence[str] = (MODEL,), target: str = "TARGET") -> DataFrame:
    """A10."""
    return df.groupBy(*group_cols, target).agg(F.count(F.lit(1)).alias("COUNT"))


def captured_positives(df: DataFrame, group_cols: Sequence[str] = (MODEL,), target: str = "TARGET",
                       pred: str = "PREDICTION") -> DataFrame:
    """Positives and predicted positives among them."""
    return (df.where(F.col(target) == 1).groupBy(*group_cols)
              .agg(F.sum(target).cast("long").alias("SUM_TARGET"),
                   F.sum(pred).cast("long").alias("SUM_PREDICTION")))


def scored_ordered(df: DataFrame, score_col: str = "y_proba", key_cols: Sequence[str] = ()) -> DataFrame:
    """O1: highest probability first (a range-partitioned global sort). ``key_cols``
    settle ties and let Spark deal the rows of one score to many tasks."""
    return df.orderBy(F.col(score_col).desc(), *key_cols)
