"""Month arithmetic, event standardisation, windows and the date dimension.

Months are carried as ``month_idx = YEAR * 12 + MONTH - 1`` so that shifts,
ranges and rolling frames are integer arithmetic. Window predicates are
written as half-open ranges on ``EVT_DT`` with literal bounds, which Spark
pushes into the Parquet scan (a filter on ``year(EVT_DT)`` is not pushed).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_idx(date_col: str | Column = "EVT_DT") -> Column:
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.year(c) * 12 + F.month(c) - 1


def month_idx_of(year_col: str = "YEAR", month_col: str = "MONTH") -> Column:
    return F.col(year_col) * 12 + F.col(month_col) - 1


def year_of(idx: Column) -> Column:
    return F.floor(idx / 12).cast("int")


def month_of(idx: Column) -> Column:
    return (F.pmod(idx, F.lit(12)) + 1).cast("int")


def month_start(idx: int) -> dt.datetime:
    """First instant of month ``idx`` as a literal for a pushed-down range bound."""
    return dt.datetime(idx // 12, idx % 12 + 1, 1)


def standardize_events(df: DataFrame, duration_col: str | None = None) -> DataFrame:
    """EVT_DT to a date, optional DURATION rename, MONTH and YEAR added."""
    out = df.withColumn("EVT_DT", F.to_date("EVT_DT"))
    if duration_col:
        out = out.withColumnRenamed("DURATION", duration_col)
    return out.withColumn("MONTH", F.month("EVT_DT")).withColumn("YEAR", F.year("EVT_DT"))


@dataclass(frozen=True)
class SourceMonths:
    """Months present in one source: enough to place every window."""

    months: tuple[int, ...]

    @property
    def anchor(self) -> int:
        """Month of the source's latest event."""
        return self.months[-1]

    @property
    def scoring_month(self) -> int:
        """The month before the anchor's."""
        return self.anchor - 1

    def last_before(self, limit: int) -> int | None:
        cands = [m for m in self.months if m <= limit]
        return cands[-1] if cands else None

    @property
    def train_anchor(self) -> int | None:
        """Latest month left once the anchor month and the one before are dropped."""
        return self.last_before(self.anchor - 2)


def source_months(df: DataFrame, date_col: str = "EVT_DT") -> SourceMonths:
    """One scan of the date column; returns the distinct months, a set bounded
    by the calendar span (not by the row count), as one small row."""
    row = df.select(month_idx(date_col).alias("m")).agg(
        F.array_sort(F.collect_set("m")).alias("ms")).first()
    months = tuple(int(m) for m in (row["ms"] or []))
    if not months:
        raise ValueError("source has no dated rows")
    return SourceMonths(months)


def sources_months(sources: dict[str, DataFrame], date_col: str = "EVT_DT") -> dict[str, SourceMonths]:
    """``source_months`` of several sources in one job: the date columns are
    unioned with a source tag and reduced to (source, distinct months), at
    most sources x calendar months rows."""
    from functools import reduce
    parts = [df.select(F.lit(name).alias("src"), month_idx(date_col).alias("m"))
             for name, df in sources.items()]
    rows = (reduce(DataFrame.unionByName, parts).groupBy("src")
            .agg(F.array_sort(F.collect_set("m")).alias("ms")).collect())
    found = {r["src"]: tuple(int(m) for m in r["ms"]) for r in rows if r["ms"]}
    missing = [n for n in sources if n not in found]
    if missing:
        raise ValueError(f"sources without dated rows: {missing}")
    return {n: SourceMonths(found[n]) for n in sources}


def month_range_filter(df: DataFrame, first_month: int, last_month: int,
                       date_col: str = "EVT_DT") -> DataFrame:
    """Rows whose month lies in [first_month, last_month], as a pushed range."""
    c = F.col(date_col)
    return df.where((c >= F.lit(month_start(first_month))) & (c < F.lit(month_start(last_month + 1))))


def exclude_last_months(df: DataFrame, anchor: int, n: int = 2, date_col: str = "EVT_DT") -> DataFrame:
    """Drop the anchor month and the n-1 months before it."""
    return df.where(F.col(date_col) < F.lit(month_start(anchor - n + 1)))


def keep_month(df: DataFrame, month: int, date_col: str = "EVT_DT") -> DataFrame:
    """Keep a single month (the scoring month M-1)."""
    return month_range_filter(df, month, month, date_col)


def last_n_months(df: DataFrame, last_month: int, n: int = 3, date_col: str = "EVT_DT") -> DataFrame:
    """P5: the n months ending at ``last_month``."""
    return month_range_filter(df, last_month - n + 1, last_month, date_col)


def shift_months(df: DataFrame, n: int, year_col: str = "YEAR", month_col: str = "MONTH") -> DataFrame:
    """P10: move (YEAR, MONTH) by n months, wrapping the year."""
    idx = month_idx_of(year_col, month_col) + F.lit(n)
    return df.withColumn(year_col, year_of(idx)).withColumn(month_col, month_of(idx))


def date_dimension(dates: DataFrame, date_col: str) -> DataFrame:
    """One row per day from 1 Jan of the first year to 31 Dec of the last
    year found in ``date_col``; the range is generated on the executors."""
    bounds = dates.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    days = bounds.select(F.explode(F.sequence(
        F.make_date(F.year("lo"), F.lit(1), F.lit(1)),
        F.make_date(F.year("hi"), F.lit(12), F.lit(31)),
        F.expr("interval 1 day"))).alias("Date"))
    q = F.quarter("Date")
    return days.select(
        "Date",
        F.year("Date").alias("Year"),
        F.month("Date").alias("MonthNo"),
        F.date_format("Date", "MMMM").alias("Month"),
        q.alias("QuarterNo"),
        F.concat(F.lit("Qtr "), q.cast("string")).alias("Quarter"),
        F.dayofmonth("Date").alias("Day"))
