"""Ranks, tiles and running sums inside groups without a one-task group.

A window ``partitionBy(g).orderBy(v)`` sorts a whole group in one task. The
groups here are few and large (three models, 27 category-months), so one of
them can hold a third of all rows. Instead:

1. ``repartitionByRange`` on (group, order) spreads every group over many
   range partitions whose sizes come from Spark's sample of the keys; each row
   keeps the number of its range partition;
2. a window over (range partition, group), which is as small as a range
   partition is, gives running sums. The rows are written with both, once, to the
   shared checkpoint folder, so every later branch reads the very same partitions
   (two evaluations of a range exchange would sample different boundaries), only
   the columns it needs, and a lost executor does not change them;
3. per (partition, group) block totals, at most partitions + groups rows, are
   turned into offsets by a window over that small table and joined back. Spark
   broadcasts that table only when its measured size is small.

All of it is JVM code, so groups of any type match as SQL groups them, nulls with nulls.

The rows fed in must be unique on (group, order); callers pre-aggregate ties
(distinct values with counts) or add a unique tie-break column.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

_PID = "_rk_pid"


def _sort_exprs(group_cols: Sequence[str], order: Sequence[tuple[str, bool]]) -> list[Column]:
    exprs = [F.col(g).asc() for g in group_cols]
    for name, ascending in order:
        exprs.append(F.col(name).asc() if ascending else F.col(name).desc())
    return exprs


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def prefix_sums(df: DataFrame, group_cols: Sequence[str], order: Sequence[tuple[str, bool]],
                weight_cols: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """Add ``<w>_before`` (sum of w over earlier rows of the group, in order)
    and ``<w>_total`` (group sum) for every weight column ``w``.

    Weights are whole numbers (counts in every caller), so the sums are exact.
    """
    group_cols = list(group_cols)
    weight_cols = list(weight_cols)
    n = _num_partitions(df, num_partitions)
    sort = _sort_exprs(group_cols, order)
    earlier = Window.partitionBy(_PID, *group_cols).orderBy(*sort[len(group_cols):]).rowsBetween(
        Window.unboundedPreceding, -1)
    local = stage(df.repartitionByRange(n, *sort).withColumn(_PID, F.spark_partition_id()).withColumns({
        f"_rk_loc_{w}": F.coalesce(F.sum(F.col(w).cast("long")).over(earlier), F.lit(0).cast("long"))
        for w in weight_cols}), "ranked")

    blocks = local.groupBy(_PID, *group_cols).agg(
        *[F.sum(F.col(w).cast("long")).alias(f"_rk_blk_{w}") for w in weight_cols])
    before_w = Window.partitionBy(*group_cols).orderBy(_PID).rowsBetween(
        Window.unboundedPreceding, -1)
    whole_w = Window.partitionBy(*group_cols)
    offsets = stage(blocks.select(
        _PID, *group_cols,
        *[F.coalesce(F.sum(f"_rk_blk_{w}").over(before_w), F.lit(0).cast("long")).alias(f"_rk_off_{w}")
          for w in weight_cols],
        *[F.sum(f"_rk_blk_{w}").over(whole_w).alias(f"{w}_total") for w in weight_cols]), "rank-offsets")

    joined = null_safe_join(local, offsets, [_PID, *group_cols], "inner")
    cols = [F.col(c) for c in df.columns]
    cols += [(F.col(f"_rk_loc_{w}") + F.col(f"_rk_off_{w}")).alias(f"{w}_before") for w in weight_cols]
    cols += [F.col(f"{w}_total") for w in weight_cols]
    return joined.select(*cols)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which null keys match each other, as they do in a window's groups."""
    right = right.withColumnsRenamed({k: f"_rk_key_{k}" for k in keys})
    match = reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_rk_key_{k}"]) for k in keys])
    return left.join(right, match, how).drop(*[f"_rk_key_{k}" for k in keys])


def value_ranks(df: DataFrame, group_cols: Sequence[str], value_col: str,
                ascending: bool = True, num_partitions: int | None = None) -> DataFrame:
    """One row per distinct (group, value) with ``rows_before`` (rows of the
    group strictly before the value), ``value_rows`` and ``group_rows``."""
    counts = df.groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_rk_n"))
    ps = prefix_sums(counts, group_cols, [(value_col, ascending)], ["_rk_n"], num_partitions)
    return ps.select(*group_cols, value_col,
                     F.col("_rk_n_before").alias("rows_before"),
                     F.col("_rk_n").alias("value_rows"),
                     F.col("_rk_n_total").alias("group_rows"))


def with_percent_rank(df: DataFrame, group_cols: Sequence[str], value_col: str,
                      out_col: str = "PERCENT_RANK", num_partitions: int | None = None) -> DataFrame:
    """``percent_rank() over (partition by group order by value)`` for every row."""
    ranks = value_ranks(df, group_cols, value_col, True, num_partitions)
    pr = (F.when(F.col("group_rows") > 1,
                 F.col("rows_before").cast("double") / (F.col("group_rows") - 1).cast("double"))
          .otherwise(F.lit(0.0)))
    ranks = ranks.select(*group_cols, value_col, pr.alias(out_col))
    return null_safe_join(df, ranks, [*group_cols, value_col], "left")


def with_competition_rank(df: DataFrame, group_cols: Sequence[str], value_col: str,
                          ascending: bool = False, out_col: str = "RANK",
                          count_col: str | None = None,
                          num_partitions: int | None = None) -> DataFrame:
    """``rank()`` (ties share the lowest rank, next rank skips) per group;
    optionally the group row count as ``count_col``."""
    ranks = value_ranks(df, group_cols, value_col, ascending, num_partitions)
    sel = [*group_cols, value_col, (F.col("rows_before") + 1).alias(out_col)]
    if count_col:
        sel.append(F.col("group_rows").alias(count_col))
    return null_safe_join(df, ranks.select(*sel), [*group_cols, value_col], "left")


def with_row_number(df: DataFrame, group_cols: Sequence[str], order: Sequence[tuple[str, bool]],
                    out_col: str = "ROW_NUM", count_col: str = "GROUP_ROWS",
                    num_partitions: int | None = None) -> DataFrame:
    """``row_number()`` per group under a total order (order must be unique
    within the group) plus the group row count."""
    tmp = df.withColumn("_rk_one", F.lit(1))
    ps = prefix_sums(tmp, group_cols, order, ["_rk_one"], num_partitions)
    return ps.select(*df.columns, (F.col("_rk_one_before") + 1).alias(out_col),
                     F.col("_rk_one_total").alias(count_col))
