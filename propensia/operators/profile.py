"""Dataset profile (A7-A9): summary statistics, null share, correlations.

Each is a fixed number of passes over the data whatever its size. Exact
quartiles come from distributed ranks of each column's distinct values
(never one buffer holding a whole column, as the exact ``percentile``
aggregate would).
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ranking import value_ranks
from ..session import stage


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def exact_quantiles(long: DataFrame, group_cols: Sequence[str], value_col: str,
                    qs: Sequence[float]) -> DataFrame:
    """Per group, the exact linear-interpolated quantiles ``qs`` of
    ``value_col`` (nulls ignored) as columns ``q0, q1, …``."""
    g = list(group_cols)
    r = value_ranks(long.where(F.col(value_col).isNotNull()), g, value_col, True)
    aggs = []
    for i, q in enumerate(qs):
        pos = (F.col("group_rows") - 1).cast("double") * F.lit(q)
        for side, bound in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            inside = (F.col("rows_before") <= bound) & (bound < F.col("rows_before") + F.col("value_rows"))
            aggs.append(F.max(F.when(inside, F.col(value_col))).alias(f"_{side}{i}"))
        aggs.append(F.first(pos).alias(f"_pos{i}"))
    per = r.groupBy(*g).agg(*aggs)
    outs = []
    for i in range(len(qs)):
        lo, hi, pos = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_pos{i}")
        outs.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(f"q{i}"))
    return per.select(*g, *outs)


def summary_stats(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """A7 (exact variant): one row per numeric column with count, mean,
    sample stddev, min, exact 25/50/75 % (linear), max. Mean and stddev are
    rounded to ``digits`` so that summation order cannot change them."""
    cols = list(columns or numeric_columns(df))
    df = stage(df.select(*[F.col(c).cast("double").alias(c) for c in cols]))  # read by the moments and by the quantiles
    moments = df.agg(*[F.struct(F.lit(c).alias("column"), F.count(c).alias("count"),
                                F.round(F.avg(c), digits).alias("mean"),
                                F.round(F.stddev_samp(c), digits).alias("stddev"),
                                F.min(c).alias("min"), F.max(c).alias("max")).alias(f"m{i}")
                       for i, c in enumerate(cols)])
    basic = moments.select(F.inline(F.array(*[f"m{i}" for i in range(len(cols))])))
    long = df.unpivot([], cols, "column", "value")
    qs = exact_quantiles(long, ["column"], "value", [0.25, 0.5, 0.75]).select(
        "column", F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"))
    return basic.join(qs, on="column", how="left").select(
        "column", "count", "mean", "stddev", "min", "p25", "p50", "p75", "max")


def summary_stats_approx(df: DataFrame, columns: Sequence[str] | None = None, rank_error: float = 0.001, digits: int = 6) -> DataFrame:
    """A7 (approximate variant): as ``summary_stats``, but each quartile is a value of the column whose rank is
    off by at most ``rank_error`` of its rows, and one row.

    One pass without sort or unpivot: every task keeps a quantile summary per column, whose size hangs on
    ``rank_error`` and not on the rows, and the summaries are merged."""
    cols = list(columns or numeric_columns(df))
    accuracy = F.lit(int(np.ceil(1 / rank_error)))
    parts = []
    for c in cols:
        v = F.col(c).cast("double")
        q = F.percentile_approx(v, [0.25, 0.5, 0.75], accuracy)
        parts.append(F.struct(F.lit(c).alias("column"), F.count(v).alias("count"), F.round(F.avg(v), digits).alias("mean"), F.round(F.stddev_samp(v), digits).alias("stddev"),
                              F.min(v).alias("min"), q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75"), F.max(v).alias("max")))
    one = df.agg(*[p.alias(f"m{i}") for i, p in enumerate(parts)])
    return one.select(F.inline(F.array(*[f"m{i}" for i in range(len(cols))])))


def quantile_rank_errors(df: DataFrame, summary: DataFrame) -> DataFrame:
    """column, quantile, rank_error: how far, as a share of the column's rows, the exact ranks of each
    quartile's value are from the rank asked for; 0 if one of its equal rows has it, null for a column
    without values. A check of a summary, by one more pass over the rows."""
    parts = F.array(*[F.struct(F.lit(q).alias("quantile"), F.col(p).alias("at")) for q, p in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    asked = summary.select("column", F.inline(parts))   # three rows per column
    cols = [r["column"] for r in summary.select("column").collect()]
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "value").where("value is not null")
    found = long.join(F.broadcast(asked), "column").groupBy("column", "quantile").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") < F.col("at")).alias("below"), F.count_if(F.col("value") <= F.col("at")).alias("upto"))
    want = F.ceil(F.col("n") * F.col("quantile"))
    off = F.greatest(F.col("below") + 1 - want, want - F.col("upto"), F.lit(0)) / F.col("n")
    return asked.select("column", "quantile").join(found.select("column", "quantile", off.alias("rank_error")), ["column", "quantile"], "left")


def null_share(df: DataFrame) -> DataFrame:
    """Share of nulls per column, one aggregate, one row."""
    return df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in df.columns])


def correlation_pairs(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 2) -> DataFrame:
    """Pearson correlation of every pair of numeric columns (upper
    triangle), rounded, as a long table ``(col1, col2, corr)``.

    Two passes over the data. First the column means (one value per
    column, bounded by the schema). Then every task accumulates the centred
    cross-product matrix of its rows in numpy (``a.T @ a`` over Arrow
    batches) and emits one row per upper-triangle cell; Spark sums the cells
    over tasks (map-side combined, at most k(k+1)/2 groups). A wide
    aggregate with one expression per pair would instead grow the plan with
    the square of the column count. Centring keeps a constant column at
    exactly zero variance, which gives a null correlation. Nulls in these
    columns are an error (the training set is profiled after the -1 fill).
    """
    cols = list(columns or numeric_columns(df))
    k = len(cols)
    x = stage(df.select(*[F.col(c).cast("double").alias(c) for c in cols]))  # two passes
    row = x.agg(*[F.avg(c).alias(c) for c in cols], *[F.count_if(F.col(c).isNull()).alias(f"_nulls_{c}") for c in cols]).first()
    if holes := [c for c in cols if row[f"_nulls_{c}"]]:
        raise ValueError(f"correlation_pairs: fill the nulls of {', '.join(holes)} first")
    mu = np.array([row[c] if row[c] is not None else 0.0 for c in cols], dtype="float64")
    iu, ju = np.triu_indices(k)

    def cross_products(batches):
        acc = np.zeros((k, k), dtype="float64")
        for pdf in batches:
            a = pdf[cols].to_numpy(dtype="float64") - mu
            acc += a.T @ a
        yield pd.DataFrame({"i": iu.astype("int32"), "j": ju.astype("int32"), "s": acc[iu, ju]})

    cells = (x.mapInPandas(cross_products, "i int, j int, s double")
              .groupBy("i", "j").agg(F.sum("s").alias("s")))
    var = cells.where(F.col("i") == F.col("j")).select("i", F.col("s").alias("v"))
    va, vb = var.select(F.col("i").alias("i"), F.col("v").alias("va")), var.select(
        F.col("i").alias("j"), F.col("v").alias("vb"))
    names = F.array(*[F.lit(c) for c in cols])
    corr = F.when((F.col("va") > 0) & (F.col("vb") > 0), F.col("s") / F.sqrt(F.col("va") * F.col("vb")))
    return (cells.where(F.col("i") < F.col("j")).join(va, "i").join(vb, "j")
            .select(F.element_at(names, F.col("i") + 1).alias("col1"),
                    F.element_at(names, F.col("j") + 1).alias("col2"),
                    F.round(corr, digits).alias("corr")))
