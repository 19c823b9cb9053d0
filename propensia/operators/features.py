"""Monthly customer feature tables (internet, TV, journeys, mobile, socio, requests).

Every table is one aggregation to the (customer, category, month) grain with
map-side partial aggregation, then one conditional aggregation to the
(customer, month) grain with an explicit category list (never a data-driven
pivot, which costs an extra job and yields data-dependent columns).

Distinct active days inside one month are counted with a 31-bit day mask
(``bit_or(1 << day)`` then ``bit_count``): exact, fixed width, fully
code-generated, and mergeable, so the per-type masks also give the per-month
total without a second aggregate or a self-join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import (SourceMonths, month_idx, month_range_filter,
                                  standardize_events, year_of, month_of)
from ..functions.ranking import with_percent_rank
from ..session import stage
from ..sources.fixtures import CONTACT_TYPES, TV_PROGRAMS, WEBSITE_TYPES

KEYS = ["CUST_NUM", "MONTH", "YEAR"]


def day_mask(date_col: str = "EVT_DT") -> Column:
    """Per-row bit for the day of month; OR-ed per group it is the set of active days."""
    return F.expr(f"shiftleft(1L, dayofmonth(`{date_col}`))")


def days_in_mask(mask: Column) -> Column:
    return F.bit_count(mask).cast("long")


# ---------------------------------------------------------------------------
# Windows (P3, P4, P5 placed from the source's own months, H13 aside)


@dataclass(frozen=True)
class MonthWindow:
    first: int | None  # inclusive month_idx, None = unbounded
    last: int          # inclusive month_idx

    def apply(self, df: DataFrame, date_col: str = "EVT_DT") -> DataFrame:
        if self.first is None:
            return df.where(F.col(date_col) < F.lit(_start(self.last + 1)))
        return month_range_filter(df, self.first, self.last, date_col)


def _start(idx: int):
    from ..functions.calendar import month_start
    return month_start(idx)


def l3m_window(months: SourceMonths, mode: str, n_months: int = 3) -> MonthWindow:
    """The months a usage / journey / mobile table aggregates.

    train: drop the anchor month and the one before, then keep the n months
    ending at the latest remaining month. score: the month before the anchor.
    """
    if mode == "train":
        a = months.train_anchor
        if a is None:
            return MonthWindow(months.anchor - 1, months.anchor - 2)  # empty
        return MonthWindow(a - n_months + 1, a)
    if mode == "score":
        return MonthWindow(months.scoring_month, months.scoring_month)
    raise ValueError(mode)


def all_months_window(months: SourceMonths, mode: str) -> MonthWindow:
    """Window for socio-demographics and requests: every month before M-1
    (train) or M-1 alone (score)."""
    if mode == "train":
        return MonthWindow(None, months.anchor - 2)
    if mode == "score":
        return MonthWindow(months.scoring_month, months.scoring_month)
    raise ValueError(mode)


# ---------------------------------------------------------------------------
# Usage tables


@dataclass(frozen=True)
class UsageSpec:
    prefix: str
    category_col: str
    categories: tuple[str, ...]
    duration_col: str


INTERNET = UsageSpec("INTERNET", "WEBSITE_TYPE", tuple(WEBSITE_TYPES), "DURATION_INTERNET")
TV = UsageSpec("TV", "TV_PROGRAM", tuple(TV_PROGRAMS), "DURATION_TV")


def usage_monthly(events: DataFrame, category_col: str, duration_col: str) -> DataFrame:
    """A1: per (customer, category, month): summed duration, distinct active days."""
    return events.groupBy("CUST_NUM", category_col, "MONTH", "YEAR").agg(
        F.sum(duration_col).alias("DURATION_L3M"),
        days_in_mask(F.bit_or(day_mask("EVT_DT"))).alias("NB_DAYS_USAGE_L3M"))


def usage_rank(monthly: DataFrame, category_col: str, rank_col: str,
               extra_group: Sequence[str] = ()) -> DataFrame:
    """``int(percent_rank * 99 + 1)`` of duration inside (category, month)."""
    ranked = with_percent_rank(monthly, [*extra_group, category_col, "MONTH", "YEAR"], "DURATION_L3M", "_PR")
    return ranked.withColumn(rank_col, (F.col("_PR") * 99 + 1).cast("int")).drop("_PR")


def _usage_names(spec: UsageSpec, cat: str) -> tuple[str, str, str]:
    p = spec.prefix
    return (f"{p}_DURATION_{cat}_L3M_SECONDES", f"{p}_DURATION_{cat}_L3M_DAYS", f"{p}_RANK_{cat}_L3M")


def usage_feature_columns(spec: UsageSpec) -> list[str]:
    return [n for c in spec.categories for n in _usage_names(spec, c)]


def pivot_max(df: DataFrame, keys: Sequence[str], category_col: str, categories: Sequence[str],
              measures: Sequence[tuple[str, str]]) -> list[Column]:
    """``max(measure) filtered on category`` for each (category, measure, name):
    the explicit-value pivot as one aggregate."""
    out = []
    for cat in categories:
        hit = F.col(category_col) == F.lit(cat)
        for src, name_fmt in measures:
            out.append(F.max(F.when(hit, F.col(src))).alias(name_fmt.format(cat=cat)))
    return out


def usage_features(raw: DataFrame, spec: UsageSpec, window: MonthWindow) -> DataFrame:
    """A2: monthly usage, rank and pivot into the wide per-customer-month table."""
    return usage_features_many([(raw, spec, window)])[0]


def usage_features_many(parts: Sequence[tuple[DataFrame, UsageSpec, MonthWindow]]) -> list[DataFrame]:
    """A2 for several usage sources at once (internet and TV).

    The sources' monthly aggregates are unioned with a source number and
    written once (the table feeds both the ranks and the join back), and
    one ranking pass, written once too, serves all of them, the source being part of the
    rank group; each source's ranks are those it would get alone. One source's
    feature table is then its slice, pivoted."""
    monthly = []
    for i, (raw, spec, window) in enumerate(parts):
        ev = standardize_events(window.apply(raw), spec.duration_col)
        monthly.append(usage_monthly(ev, spec.category_col, spec.duration_col).select(
            F.lit(i).alias("_src"), "CUST_NUM", F.col(spec.category_col).alias("_cat"),
            "MONTH", "YEAR", "DURATION_L3M", "NB_DAYS_USAGE_L3M"))
    allm = stage(reduce(lambda a, b: a.unionByName(b), monthly), "usage-monthly")
    ranked = stage(usage_rank(allm, "_cat", "_RANK", extra_group=["_src"]), "usage-ranked")
    outs = []
    for i, (_, spec, _) in enumerate(parts):
        p = spec.prefix
        aggs = pivot_max(ranked.where(F.col("_src") == i), KEYS, "_cat", spec.categories, [
            ("DURATION_L3M", p + "_DURATION_{cat}_L3M_SECONDES"),
            ("NB_DAYS_USAGE_L3M", p + "_DURATION_{cat}_L3M_DAYS"),
            ("_RANK", p + "_RANK_{cat}_L3M")])
        outs.append(ranked.where(F.col("_src") == i).groupBy(*KEYS).agg(*aggs))
    return outs


def usage_rolling_3m(raw: DataFrame, spec: UsageSpec, window: MonthWindow) -> DataFrame:
    """Per customer and category, totals over the current and two previous
    months (a true rolling three-month frame over month_idx)."""
    ev = standardize_events(window.apply(raw), spec.duration_col)
    monthly = usage_monthly(ev, spec.category_col, spec.duration_col).withColumn(
        "_m", month_idx_of_keys())
    w = (Window.partitionBy("CUST_NUM", spec.category_col).orderBy("_m").rangeBetween(-2, 0))
    return monthly.select(
        "CUST_NUM", spec.category_col, "MONTH", "YEAR",
        F.sum("DURATION_L3M").over(w).alias("DURATION_R3M"),
        F.sum("NB_DAYS_USAGE_L3M").over(w).alias("NB_DAYS_R3M"),
        F.count(F.lit(1)).over(w).alias("NB_MONTHS_R3M"))


def month_idx_of_keys() -> Column:
    return F.col("YEAR") * 12 + F.col("MONTH") - 1


# ---------------------------------------------------------------------------
# Journeys (A3, J4 folded into one aggregate)

# Fixed values.
JOURNEY_SELECTED = [  # columns the assembled datasets keep (H14)
    "AMOUNT_OF_CONTACT_ADMINISTRATIVE_ISSUES_L3M", "AMOUNT_OF_CONTACT_COMPLAINTS_L3M",
    "JOURNEY_DURATION_ADMINISTRATIVE_ISSUES_L3M_DAYS", "JOURNEY_DURATION_COMPLAINTS_L3M_DAYS",
    "JOURNEY_DURATION_TECHNICAL_ISSUES_L3M_DAYS", "TOTAL_NUMBER_OF_CONTACTS_L3M",
    "TOTAL_NUMBER_OF_JOURNEYS_L3M"]


def journey_features(raw: DataFrame, window: MonthWindow,
                     contact_types: Sequence[str] = CONTACT_TYPES) -> DataFrame:
    ev = standardize_events(window.apply(raw))
    detail = ev.groupBy("CUST_NUM", "CONTACT_TYPE", "MONTH", "YEAR").agg(
        F.sum("NB_CONTACTS").alias("AMOUNT_OF_CONTACT_L3M"),
        F.bit_or(day_mask("EVT_DT")).alias("_mask"))
    detail = detail.withColumn("NB_DAYS_WITH_L3M", days_in_mask(F.col("_mask")))
    aggs = pivot_max(detail, KEYS, "CONTACT_TYPE", contact_types, [
        ("AMOUNT_OF_CONTACT_L3M", "AMOUNT_OF_CONTACT_{cat}_L3M"),
        ("NB_DAYS_WITH_L3M", "JOURNEY_DURATION_{cat}_L3M_DAYS")])
    aggs += [days_in_mask(F.bit_or("_mask")).alias("TOTAL_NUMBER_OF_JOURNEYS_L3M"),
             F.sum("AMOUNT_OF_CONTACT_L3M").alias("TOTAL_NUMBER_OF_CONTACTS_L3M")]
    return detail.groupBy(*KEYS).agg(*aggs)


# ---------------------------------------------------------------------------
# Mobile (A4), socio-demographics (A5), requests


def mobile_features(raw: DataFrame, window: MonthWindow, parity_month_year: bool = False) -> DataFrame:
    """Two-level aggregate: per month, then per customer over the window.

    MONTH/YEAR are those of the customer's latest month in the window. With
    ``parity_month_year`` they are max(MONTH) and max(YEAR) taken separately,
    as the reference does (wrong across a year end, H3).
    """
    ev = standardize_events(window.apply(raw))
    per_month = ev.groupBy("CUST_NUM", "MONTH", "YEAR").agg(
        F.sum("OUT_OF_BUNDLE").alias("AMOUNT_OUT_OF_BUNDLE"),
        days_in_mask(F.bit_or(day_mask("EVT_DT"))).alias("NB_DAYS_OUT_OF_BUNDLE"))
    sums = [F.sum("AMOUNT_OUT_OF_BUNDLE").alias("AMOUNT_OUT_OF_BUNDLE_L3M"),
            F.sum("NB_DAYS_OUT_OF_BUNDLE").alias("NB_DAYS_OUT_OF_BUNDLE_L3M")]
    if parity_month_year:
        return per_month.groupBy("CUST_NUM").agg(*sums, F.max("MONTH").alias("MONTH"),
                                                 F.max("YEAR").alias("YEAR"))
    out = per_month.groupBy("CUST_NUM").agg(*sums, F.max(month_idx_of_keys()).alias("_m"))
    return out.select("CUST_NUM", "AMOUNT_OUT_OF_BUNDLE_L3M", "NB_DAYS_OUT_OF_BUNDLE_L3M",
                      month_of(F.col("_m")).alias("MONTH"), year_of(F.col("_m")).alias("YEAR"))


SOCIO_COLUMNS = ["CUST_AGE", "NB_MOBILE_SUBS", "NB_DAYS_INTERNET_LINE", "NB_DAYS_TV_LINE"]


def socio_features(raw: DataFrame, window: MonthWindow) -> DataFrame:
    ev = standardize_events(window.apply(raw))
    return ev.groupBy(*KEYS).agg(*[F.avg(c).alias(f"AVG_{c}") for c in SOCIO_COLUMNS])


def request_months(raw: DataFrame, window: MonthWindow) -> DataFrame:
    """The requests feature table is the standardised rows minus EVT_DT."""
    return standardize_events(window.apply(raw)).drop("EVT_DT")


def dedupe_events(raw: DataFrame) -> DataFrame:
    """Exact-row de-duplication (the reference calls it without using the result)."""
    return raw.dropDuplicates()


def filter_active_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows whose horizontal sum over ``columns`` is positive."""
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in columns[1:]),
                F.coalesce(F.col(columns[0]), F.lit(0)))
    return df.where(total > 0)
