"""Queries over the raw event sources and the six monthly feature tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import features as fx
from ..sources import fixtures
from ..sources.fixtures import EVENT_SOURCES
from . import featureset as fs
from . import sqlgen as sg
from .catalog import register


def _src(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return EVENT_SOURCES[name](spark, sf_dir)


def _fx(*names: str) -> list[sg.Cte]:
    return sg.fixture_ctes(*names)


# --------------------------------------------------------------------------- P1


@register("standardize_events", "P1", sg.render(_fx("internet"), """
select CUST_NUM, cast(EVT_DT as date) as EVT_DT, WEBSITE_TYPE, DURATION as DURATION_INTERNET,
       cast(month(EVT_DT) as integer) as MONTH, cast(year(EVT_DT) as integer) as YEAR
from internet"""))
def q_standardize_events(spark, sf_dir):
    return cal.standardize_events(_src(spark, sf_dir, "internet"), "DURATION_INTERNET")


# --------------------------------------------------------------------------- P2

_ANCHOR_SRCS = ["internet", "tv", "mobile", "journeys", "socio_demo", "requests"]


@register("anchor_date", "P2", sg.render(_fx(*_ANCHOR_SRCS), "\nunion all\n".join(
    f"""select '{s}' as SOURCE, max(EVT_DT) as MAX_EVT_DT,
       cast(year(max(EVT_DT)) as integer) as ANCHOR_YEAR,
       cast(month(max(EVT_DT)) as integer) as ANCHOR_MONTH from {s}""" for s in _ANCHOR_SRCS)))
def q_anchor_date(spark, sf_dir):
    parts = [_src(spark, sf_dir, s).agg(F.max("EVT_DT").alias("MAX_EVT_DT"))
             .select(F.lit(s).alias("SOURCE"), "MAX_EVT_DT",
                     F.year("MAX_EVT_DT").alias("ANCHOR_YEAR"),
                     F.month("MAX_EVT_DT").alias("ANCHOR_MONTH"))
             for s in _ANCHOR_SRCS]
    return reduce(DataFrame.unionByName, parts)


# --------------------------------------------------------------------------- P3-P5


def _mi_rows(src: str, pred: str) -> str:
    return f"""select CUST_NUM, EVT_DT, WEBSITE_TYPE, DURATION from
      (select *, year(EVT_DT) * 12 + month(EVT_DT) - 1 as mi from {src}) where {pred}"""


@register("train_window", "P3", sg.render(_fx("internet") + sg.month_ctes("internet"),
          _mi_rows("internet", sg.window_pred("internet", "train", "all"))))
def q_train_window(spark, sf_dir):
    raw = _src(spark, sf_dir, "internet")
    m = cal.source_months(raw)
    return cal.exclude_last_months(raw, m.anchor, 2)


@register("scoring_window", "P4", sg.render(_fx("internet") + sg.month_ctes("internet"),
          _mi_rows("internet", sg.window_pred("internet", "score", "all"))))
def q_scoring_window(spark, sf_dir):
    raw = _src(spark, sf_dir, "internet")
    m = cal.source_months(raw)
    return cal.keep_month(raw, m.scoring_month)


@register("last_n_months", "P5", sg.render(_fx("internet") + sg.month_ctes("internet"),
          _mi_rows("internet", sg.window_pred("internet", "train", "l3m"))))
def q_last_n_months(spark, sf_dir):
    raw = _src(spark, sf_dir, "internet")
    m = cal.source_months(raw)
    return cal.last_n_months(raw, m.train_anchor, 3)


# --------------------------------------------------------------------------- P6, P7, P21


@register("dedupe_events", "P6", sg.render(_fx("tv"), "select distinct * from tv"))
def q_dedupe_events(spark, sf_dir):
    return fx.dedupe_events(_src(spark, sf_dir, "tv"))


@register("request_months", "P7", sg.render(
    _fx("requests") + sg.requests_ctes("requests", "train", "f_requests"), "select * from f_requests"))
def q_request_months(spark, sf_dir):
    return fs.requests_table(_src(spark, sf_dir, "requests"), "train")


_ACTIVE_COLS = ["AMOUNT_OF_CONTACT_ADMINISTRATIVE_ISSUES_L3M", "AMOUNT_OF_CONTACT_COMPLAINTS_L3M",
                "AMOUNT_OF_CONTACT_TECHNICAL_ISSUES_L3M"]


@register("filter_active_rows", "P21", sg.render(
    _fx("journeys") + sg.journey_ctes("journeys", "train", "f_journeys"),
    "select * from f_journeys where " + " + ".join(f"coalesce({c}, 0)" for c in _ACTIVE_COLS) + " > 0"))
def q_filter_active_rows(spark, sf_dir):
    j = fs.journeys_table(_src(spark, sf_dir, "journeys"), "train")
    return fx.filter_active_rows(j, _ACTIVE_COLS)


@register("filter_mobile_subscribers", "P21", sg.render(
    _fx("socio_demo"), "select * from socio_demo where NB_MOBILE_SUBS > 0"))
def q_filter_mobile_subscribers(spark, sf_dir):
    return fx.filter_active_rows(_src(spark, sf_dir, "socio_demo"), ["NB_MOBILE_SUBS"])


# --------------------------------------------------------------------------- A1, W1, W8


def _internet_l3m(spark, sf_dir):
    raw = _src(spark, sf_dir, "internet")
    win = fx.l3m_window(cal.source_months(raw), "train")
    return cal.standardize_events(win.apply(raw), "DURATION_INTERNET")


_USAGE_CTES = _fx("internet") + sg.usage_ctes(fx.INTERNET, "internet", "train", "f_internet")


@register("usage_monthly", "A1", sg.render(_USAGE_CTES, "select * from f_internet_agg"))
def q_usage_monthly(spark, sf_dir):
    return fx.usage_monthly(_internet_l3m(spark, sf_dir), "WEBSITE_TYPE", "DURATION_INTERNET")


@register("usage_rank", "W1", sg.render(_USAGE_CTES, """
select CUST_NUM, WEBSITE_TYPE, MONTH, YEAR, DURATION_L3M, NB_DAYS_USAGE_L3M, RK as INTERNET_RANK
from f_internet_rk"""))
def q_usage_rank(spark, sf_dir):
    monthly = fx.usage_monthly(_internet_l3m(spark, sf_dir), "WEBSITE_TYPE", "DURATION_INTERNET")
    return fx.usage_rank(monthly, "WEBSITE_TYPE", "INTERNET_RANK")


@register("usage_rolling_3m", "W8", sg.render(_fx("tv") + sg.month_ctes("tv") + [
    ("agg", f"""select CUST_NUM, TV_PROGRAM, MONTH, YEAR, cast(sum(DURATION) as bigint) as DUR,
        count(distinct d) as ND
      from ({sg._std('tv', 'train', 'all', 'CUST_NUM, TV_PROGRAM, DURATION')})
      group by CUST_NUM, TV_PROGRAM, MONTH, YEAR""")], """
select CUST_NUM, TV_PROGRAM, MONTH, YEAR,
  cast(sum(DUR) over w as bigint) as DURATION_R3M,
  cast(sum(ND) over w as bigint) as NB_DAYS_R3M,
  count(*) over w as NB_MONTHS_R3M
from agg
window w as (partition by CUST_NUM, TV_PROGRAM order by YEAR * 12 + MONTH - 1
             range between 2 preceding and current row)"""))
def q_usage_rolling_3m(spark, sf_dir):
    raw = _src(spark, sf_dir, "tv")
    win = fx.all_months_window(cal.source_months(raw), "train")
    return fx.usage_rolling_3m(raw, fx.TV, win)


# --------------------------------------------------------------------------- A2-A5


@register("internet_features", "A2 P8", sg.render(_USAGE_CTES, "select * from f_internet"))
def q_internet_features(spark, sf_dir):
    return fs.internet_table(_src(spark, sf_dir, "internet"), "train")


@register("tv_features", "A2 P8", sg.render(
    _fx("tv") + sg.usage_ctes(fx.TV, "tv", "train", "f_tv"), "select * from f_tv"))
def q_tv_features(spark, sf_dir):
    return fs.tv_table(_src(spark, sf_dir, "tv"), "train")


@register("tv_features_scoring", "A2 (scoring twin)", sg.render(
    _fx("tv") + sg.usage_ctes(fx.TV, "tv", "score", "f_tv"), "select * from f_tv"))
def q_tv_features_scoring(spark, sf_dir):
    return fs.tv_table(_src(spark, sf_dir, "tv"), "score")


@register("journey_features", "A3 J4 P8", sg.render(
    _fx("journeys") + sg.journey_ctes("journeys", "train", "f_journeys"), "select * from f_journeys"))
def q_journey_features(spark, sf_dir):
    return fs.journeys_table(_src(spark, sf_dir, "journeys"), "train")


@register("mobile_features", "A4", sg.render(
    _fx("mobile") + sg.mobile_ctes("mobile", "train", "f_mobile"), "select * from f_mobile"))
def q_mobile_features(spark, sf_dir):
    return fs.mobile_table(_src(spark, sf_dir, "mobile"), "train")


@register("socio_features", "A5", sg.render(
    _fx("socio_demo") + sg.socio_ctes("socio_demo", "train", "f_socio"), "select * from f_socio"))
def q_socio_features(spark, sf_dir):
    return fs.socio_table(_src(spark, sf_dir, "socio_demo"), "train")


# Scoring-window twins: the same tables over the last complete month.


@register("internet_features_scoring", "A2 (scoring twin)", sg.render(
    _fx("internet") + sg.usage_ctes(fx.INTERNET, "internet", "score", "f_internet"), "select * from f_internet"))
def q_internet_features_scoring(spark, sf_dir):
    return fs.internet_table(_src(spark, sf_dir, "internet"), "score")


@register("journey_features_scoring", "A3 J4 (scoring twin)", sg.render(
    _fx("journeys") + sg.journey_ctes("journeys", "score", "f_journeys"), "select * from f_journeys"))
def q_journey_features_scoring(spark, sf_dir):
    return fs.journeys_table(_src(spark, sf_dir, "journeys"), "score")


@register("mobile_features_scoring", "A4 (scoring twin)", sg.render(
    _fx("mobile") + sg.mobile_ctes("mobile", "score", "f_mobile"), "select * from f_mobile"))
def q_mobile_features_scoring(spark, sf_dir):
    return fs.mobile_table(_src(spark, sf_dir, "mobile"), "score")


@register("socio_features_scoring", "A5 (scoring twin)", sg.render(
    _fx("socio_demo") + sg.socio_ctes("socio_demo", "score", "f_socio"), "select * from f_socio"))
def q_socio_features_scoring(spark, sf_dir):
    return fs.socio_table(_src(spark, sf_dir, "socio_demo"), "score")
