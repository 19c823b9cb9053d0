"""Labels and splits (M1, M2, M3, M9, M10; P9-P12)."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import month_idx_of, shift_months
from ..functions.ranking import null_safe_join, value_ranks
from ..session import stage

KEYS = ["CUST_NUM", "YEAR", "MONTH"]

# Request event that marks each target (fixed values of the source system).
TARGET_EVENTS = {"CHURN": "CHURN REQUEST", "SPORT": "SPORT REQUEST", "CINEMA": "CINEMA REQUEST"}


def event_filter(df: DataFrame, event: str) -> DataFrame:
    """Rows of one event type, four columns."""
    return df.where(F.col("EVENT_TYPE") == event).select("CUST_NUM", "YEAR", "MONTH", "EVENT_TYPE")


def next_month_targets(events: DataFrame, event: str, target_col: str) -> DataFrame:
    """P9 + P10 + P11 + A6: one row per customer-month whose next month has the event."""
    marked = event_filter(events, event).drop("EVENT_TYPE").distinct()
    return shift_months(marked, -1).withColumn(target_col, F.lit(1))


def label_next_month(df: DataFrame, events: DataFrame, event: str, target_col: str) -> DataFrame:
    """M1: left join of next-month targets, missing → 0 (P12), EVENT_TYPE dropped.

    ``events`` is the standardised request table (CUST_NUM, EVENT_TYPE, MONTH,
    YEAR). Passing the unfiltered table labels the newest training month too
    (H4); passing the assembled J6 frame reproduces the reference exactly.
    Targets are unique per key, so the join never adds rows.
    """
    targets = next_month_targets(events, event, target_col)
    out = df.join(targets, on=KEYS, how="left").fillna({target_col: 0})
    return out.drop("EVENT_TYPE") if "EVENT_TYPE" in out.columns else out


def hash_bucket(key: str | Column, buckets: int = 100) -> Column:
    """Stable bucket of a key from its md5 (same in any engine, any partitioning)."""
    k = F.col(key) if isinstance(key, str) else key
    return (F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def split_by_hash(df: DataFrame, key: str = "CUST_NUM", train_pct: int = 70,
                  out_col: str = "SPLIT") -> DataFrame:
    """M2: 70/30 split by customer hash. Unlike ``randomSplit`` it does not
    change with the partitioning, and one customer never sits on both sides."""
    return df.withColumn(out_col, F.when(hash_bucket(key) < train_pct, F.lit("train"))
                         .otherwise(F.lit("test")))


def split_by_time(df: DataFrame, test_months: int = 1, out_col: str = "SPLIT") -> DataFrame:
    """M3: the latest ``test_months`` months are the evaluation set.

    The latest month is one scalar aggregate (map-side partial max), used as
    a literal; no window over the whole table.
    """
    mi = month_idx_of("YEAR", "MONTH")
    last = df.agg(F.max(mi)).first()[0]
    return df.withColumn(out_col, F.when(mi > F.lit(last - test_months), F.lit("test"))
                         .otherwise(F.lit("train")))


def exact_quantile(df: DataFrame, group_cols: Sequence[str], value_col: str, q: float,
                   out_col: str = "QUANTILE") -> DataFrame:
    """Per-group exact quantile with linear interpolation (pandas / DuckDB
    ``quantile_cont``), found from distributed ranks: no group is ever
    gathered into one buffer."""
    r = value_ranks(df, group_cols, value_col, True)
    pos = (F.col("group_rows") - 1).cast("double") * F.lit(q)
    lo, hi = F.floor(pos), F.ceil(pos)
    inside = lambda p: (F.col("rows_before") <= p) & (p < F.col("rows_before") + F.col("value_rows"))
    per = r.groupBy(*group_cols).agg(
        F.max(F.when(inside(lo), F.col(value_col))).alias("_vlo"),
        F.max(F.when(inside(hi), F.col(value_col))).alias("_vhi"),
        F.first(pos).alias("_pos"))
    return per.select(*group_cols, (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo"))
                                    * (F.col("_pos") - F.floor("_pos"))).alias(out_col))


def propensity_label(df: DataFrame, weights: Mapping[str, float], quantile: float,
                     group_cols: Sequence[str] = ("YEAR", "MONTH"), key_cols: Sequence[str] = ("CUST_NUM",),
                     score_col: str = "PROPENSITY_SCORE", target_col: str = "TARGET") -> DataFrame:
    """M9: z-score each weighted column inside its group (population std,
    zero std → 1), weighted sum, min-max scale to [0, 1], label the rows at or
    above the group's ``quantile`` of the score. Returns ``key_cols``, the group
    columns, the score and the label; rows whose group column is null are a group of their own.

    The groups are few and hot (one per month), so no row is shuffled by them:
    each step's statistics, one row per group, are written as a small table, and
    Spark joins it by broadcast as its size is known. Only keys and weighted
    columns are staged, and the weighted sums are written once, so that scaling
    and quantile see the same doubles."""
    g, keys = list(group_cols), list(key_cols)
    df = stage(df.select(*keys, *g, *weights), "propensity-in")
    stats = stage(df.groupBy(*g).agg(*[f(c).alias(f"_{n}_{c}") for c in weights
                                       for n, f in (("mu", F.avg), ("sd", F.stddev_pop))]), "propensity-stats")
    raw = reduce(lambda a, b: a + b, [
        F.lit(w) * ((F.col(c) - F.col(f"_mu_{c}")) / F.when(F.col(f"_sd_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_sd_{c}")))
        for c, w in weights.items()])
    summed = stage(null_safe_join(df, stats, g, "inner").select(*keys, *g, raw.alias("_raw")), "propensity-sums")
    ends = stage(summed.groupBy(*g).agg(F.min("_raw").alias("_lo"), F.max("_raw").alias("_hi")), "propensity-ends")
    width = F.col("_hi") - F.col("_lo")
    scaled = null_safe_join(summed, ends, g, "inner").select(
        *keys, *g, ((F.col("_raw") - F.col("_lo")) / F.when(width == 0, F.lit(1.0)).otherwise(width)).alias(score_col))
    cut = stage(exact_quantile(scaled, g, score_col, quantile, "_thr"), "propensity-cut")
    return (null_safe_join(scaled, cut, g, "inner")
            .withColumn(target_col, (F.col(score_col) >= F.col("_thr")).cast("int")).drop("_thr"))


def wide_request_flags(requests: DataFrame, events: Mapping[str, str] = TARGET_EVENTS) -> DataFrame:
    """One row per customer-month with a 0/1 flag per request type (the wide
    shape the upstream generator produces)."""
    aggs = [F.max(F.when(F.col("EVENT_TYPE") == ev, 1).otherwise(0)).alias(f"{name.lower()}_target")
            for name, ev in events.items()]
    return (requests.groupBy("CUST_NUM", "YEAR", "MONTH").agg(*aggs)
            .withColumn("date", F.make_date("YEAR", "MONTH", F.lit(1)))
            .drop("YEAR", "MONTH"))


def unpivot_requests(wide: DataFrame, flag_events: Mapping[str, str], date_col: str = "date",
                     lag_days: int = 15) -> DataFrame:
    """Wide flags → long request events (melt, keep flagged rows, name
    each event as the notebooks expect it), minus events within ``lag_days``
    of the data's latest date (systems lag)."""
    long = wide.unpivot(["CUST_NUM", date_col], list(flag_events), "_flag_col", "FLAG")
    name = None
    for col_name, ev in flag_events.items():
        cond = F.col("_flag_col") == col_name
        name = F.when(cond, F.lit(ev)) if name is None else name.when(cond, F.lit(ev))
    long = long.where(F.col("FLAG") == 1).select(
        "CUST_NUM", name.alias("EVENT_TYPE"), F.col(date_col).alias("DATE"))
    latest = wide.agg(F.max(date_col)).first()[0]
    return long.where(F.col("DATE") < F.date_sub(F.lit(latest), lag_days))
