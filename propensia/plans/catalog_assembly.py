"""Queries over the assembled datasets: joins, labels, splits, null fill."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.columns import cast_features, fill_missing_numeric
from ..operators import assemble as asm
from ..operators import labels as lb
from ..sources.fixtures import requests as requests_fixture
from . import featureset as fs
from . import sqlgen as sg
from .catalog import register

# Churn weights of the generator's propensity score, mapped
# onto the assembled feature columns, and its positive share (1 - 0.03).
CHURN_WEIGHTS = {
    "INTERNET_DURATION_TELCO_L3M_SECONDES": 0.5,
    "INTERNET_DURATION_PRICE_COMPARATOR_L3M_SECONDES": 0.9,
    "AVG_NB_DAYS_INTERNET_LINE": -0.1,
    "AMOUNT_OF_CONTACT_COMPLAINTS_L3M": 0.7,
    "JOURNEY_DURATION_TECHNICAL_ISSUES_L3M_DAYS": 0.7,
    "AMOUNT_OF_CONTACT_ADMINISTRATIVE_ISSUES_L3M": 0.6,
    "AMOUNT_OUT_OF_BUNDLE_L3M": 0.3,
    "INTERNET_DURATION_GAMING_L3M_SECONDES": 0.6,
    "INTERNET_DURATION_NETFLIX_L3M_SECONDES": 0.1,
    "TV_DURATION_DOCUMENTARIES_L3M_SECONDES": -0.1,
}
CHURN_QUANTILE = 0.97
# The same of the two bundles; total TV usage and the number of sports seen have no assembled column.
SPORT_WEIGHTS = {
    "INTERNET_DURATION_SOCIAL_MEDIA_L3M_SECONDES": 0.1,
    "INTERNET_DURATION_PRICE_COMPARATOR_L3M_SECONDES": -0.2,
    "AMOUNT_OF_CONTACT_COMPLAINTS_L3M": -0.2,
    "JOURNEY_DURATION_TECHNICAL_ISSUES_L3M_DAYS": -0.2,
    "AMOUNT_OF_CONTACT_ADMINISTRATIVE_ISSUES_L3M": -0.2,
    "INTERNET_DURATION_KIDS_L3M_SECONDES": 0.2,
    "INTERNET_DURATION_FOOTBALL_L3M_SECONDES": 0.2,
    "INTERNET_DURATION_CYCLING_L3M_SECONDES": 0.2,
    "TV_DURATION_FOOTBALL_L3M_SECONDES": 0.2,
    "TV_DURATION_CYCLING_L3M_SECONDES": 0.2,
    "TV_DURATION_CULTURE_L3M_SECONDES": -0.1,
}
CINEMA_WEIGHTS = {
    "INTERNET_DURATION_PRICE_COMPARATOR_L3M_SECONDES": -0.2,
    "AMOUNT_OF_CONTACT_COMPLAINTS_L3M": -0.2,
    "JOURNEY_DURATION_TECHNICAL_ISSUES_L3M_DAYS": -0.2,
    "AMOUNT_OF_CONTACT_ADMINISTRATIVE_ISSUES_L3M": -0.2,
    "INTERNET_DURATION_KIDS_L3M_SECONDES": 0.2,
    "INTERNET_DURATION_NETFLIX_L3M_SECONDES": 0.35,
    "INTERNET_DURATION_DISNEY_L3M_SECONDES": 0.35,
    "INTERNET_DURATION_FOOTBALL_L3M_SECONDES": -0.1,
    "TV_DURATION_DOCUMENTARIES_L3M_SECONDES": 0.35,
    "TV_DURATION_MOVIES_L3M_SECONDES": 0.3,
    "TV_DURATION_CULTURE_L3M_SECONDES": 0.25,
}


def _tables(spark, sf_dir, mode, with_requests=False):
    return fs.build_feature_tables(fs.fixture_sources(spark, sf_dir), mode, with_requests=with_requests)


def all_requests(spark, sf_dir):
    """Every request, standardised, no window: the label source (H4)."""
    return cal.standardize_events(requests_fixture(spark, sf_dir)).drop("EVT_DT")


def training_set(spark, sf_dir, target: str = "CHURN"):
    """Assembled training features (no request fan-out) + next-month label."""
    t = _tables(spark, sf_dir, "train")
    df = asm.assemble(t.tv, t.internet, t.mobile, t.socio, t.journeys)
    return lb.label_next_month(df, all_requests(spark, sf_dir), lb.TARGET_EVENTS[target],
                               f"TARGET_{target}")


def training_set_of_all(spark, sf_dir):
    """The same assembled features with the next-month label of every target."""
    t = _tables(spark, sf_dir, "train")
    df, events = asm.assemble(t.tv, t.internet, t.mobile, t.socio, t.journeys), all_requests(spark, sf_dir)
    for target, event in lb.TARGET_EVENTS.items():
        df = lb.label_next_month(df, events, event, f"TARGET_{target}")
    return df


# ---------------------------------------------------------------------------- DuckDB parts

_ALL_REQ = ("req_all", """select CUST_NUM, EVENT_TYPE, cast(month(EVT_DT) as integer) as MONTH,
      cast(year(EVT_DT) as integer) as YEAR from requests""")


def _targets_cte(target: str) -> sg.Cte:
    ev = lb.TARGET_EVENTS[target]
    return (f"tg_{target}", f"""select CUST_NUM,
        cast(case when MONTH = 1 then YEAR - 1 else YEAR end as integer) as YEAR,
        cast(case when MONTH = 1 then 12 else MONTH - 1 end as integer) as MONTH,
        1 as TARGET_{target}
      from req_all where EVENT_TYPE = '{ev}' group by all""")


def _train_ctes(target: str = "CHURN") -> list[sg.Cte]:
    ctes = sg.feature_set_ctes("train") + sg.fixture_ctes("requests") + [_ALL_REQ, _targets_cte(target)]
    ctes.append(("assembled", sg.assembled_select(False)))
    ctes.append(("labelled", f"""select a.*, coalesce(t.TARGET_{target}, 0) as TARGET_{target}
      from assembled a left join tg_{target} t
        on a.CUST_NUM = t.CUST_NUM and a.YEAR = t.YEAR and a.MONTH = t.MONTH"""))
    return ctes


FEATURES = asm.feature_columns_in_order()


def _filled(src: str) -> str:
    cols = ["CUST_NUM", "MONTH", "YEAR"] + [f"coalesce({c}, -1) as {c}" for c in FEATURES]
    return f"select {', '.join(cols)}, TARGET_CHURN from {src}"


# ---------------------------------------------------------------------------- J1, J3, J6, J7


@register("usage_full_join", "J1", sg.render(
    sg.fixture_ctes("internet", "tv")
    + sg.usage_ctes(asm.INTERNET, "internet", "train", "f_internet")
    + sg.usage_ctes(asm.TV, "tv", "train", "f_tv"), f"""
select coalesce(t.CUST_NUM, i.CUST_NUM) as CUST_NUM, coalesce(t.YEAR, i.YEAR) as YEAR,
       coalesce(t.MONTH, i.MONTH) as MONTH, {', '.join('t.' + c for c in sg.TV_COLUMNS)},
       {', '.join('i.' + c for c in sg.INTERNET_COLUMNS)}
from f_tv t full join f_internet i
  on t.CUST_NUM = i.CUST_NUM and t.YEAR = i.YEAR and t.MONTH = i.MONTH"""))
def q_usage_full_join(spark, sf_dir):
    src = fs.fixture_sources(spark, sf_dir)
    internet, tv = fs.usage_tables(src, "train")
    return asm.usage_full_join(tv, internet)


@register("requests_left_join", "J3", sg.render(
    sg.fixture_ctes("internet", "requests")
    + sg.usage_ctes(asm.INTERNET, "internet", "train", "f_internet")
    + sg.requests_ctes("requests", "train", "f_requests"), """
select i.*, r.EVENT_TYPE from f_internet i left join f_requests r
  on i.CUST_NUM = r.CUST_NUM and i.YEAR = r.YEAR and i.MONTH = r.MONTH"""))
def q_requests_left_join(spark, sf_dir):
    src = fs.fixture_sources(spark, sf_dir)
    internet = fs.internet_table(src["internet"], "train")
    out = asm.requests_left_join(internet, fs.requests_table(src["requests"], "train"))
    return out.select(*internet.columns, "EVENT_TYPE")


@register("assemble_training", "J2 J3 J6 S5", sg.render(
    sg.feature_set_ctes("train") + sg.fixture_ctes("requests")
    + sg.requests_ctes("requests", "train", "f_requests"), sg.assembled_select(True)))
def q_assemble_training(spark, sf_dir):
    t = _tables(spark, sf_dir, "train", with_requests=True)
    return asm.assemble(t.tv, t.internet, t.mobile, t.socio, t.journeys, t.requests)


@register("assemble_scoring", "J2 J7", sg.render(sg.feature_set_ctes("score"), sg.assembled_select(False)))
def q_assemble_scoring(spark, sf_dir):
    t = _tables(spark, sf_dir, "score")
    return asm.assemble(t.tv, t.internet, t.mobile, t.socio, t.journeys)


# ---------------------------------------------------------------------------- P9, P10, M1


@register("event_filter", "P9", sg.render(
    sg.fixture_ctes("requests") + sg.requests_ctes("requests", "train", "f_requests"), """
select CUST_NUM, YEAR, MONTH, EVENT_TYPE from f_requests where EVENT_TYPE = 'CHURN REQUEST'"""))
def q_event_filter(spark, sf_dir):
    req = fs.requests_table(requests_fixture(spark, sf_dir), "train")
    return lb.event_filter(req, lb.TARGET_EVENTS["CHURN"])


@register("shift_month_back", "P10", sg.render(sg.fixture_ctes("requests") + [_ALL_REQ], """
select CUST_NUM,
  cast(case when MONTH = 1 then YEAR - 1 else YEAR end as integer) as YEAR,
  cast(case when MONTH = 1 then 12 else MONTH - 1 end as integer) as MONTH, EVENT_TYPE
from req_all where EVENT_TYPE = 'SPORT REQUEST'"""))
def q_shift_month_back(spark, sf_dir):
    ev = lb.event_filter(all_requests(spark, sf_dir), lb.TARGET_EVENTS["SPORT"])
    return cal.shift_months(ev, -1)


@register("label_next_month", "M1 P11 P12 A6 J5", sg.render(_train_ctes(), "select * from labelled"))
def q_label_next_month(spark, sf_dir):
    return training_set(spark, sf_dir, "CHURN")


@register("label_next_month_sport", "M1", sg.render(_train_ctes("SPORT"), "select * from labelled"))
def q_label_next_month_sport(spark, sf_dir):
    return training_set(spark, sf_dir, "SPORT")


@register("label_next_month_cinema", "M1", sg.render(_train_ctes("CINEMA"), "select * from labelled"))
def q_label_next_month_cinema(spark, sf_dir):
    return training_set(spark, sf_dir, "CINEMA")


# ---------------------------------------------------------------------------- P13, P14


@register("fill_missing_numeric", "P13", sg.render(_train_ctes(), _filled("labelled")))
def q_fill_missing_numeric(spark, sf_dir):
    return fill_missing_numeric(training_set(spark, sf_dir))


@register("cast_features", "P14", sg.render(_train_ctes(), f"""
select CUST_NUM, MONTH, YEAR, {', '.join(f'cast({c} as double) as {c}' for c in FEATURES)}, TARGET_CHURN
from ({_filled('labelled')})"""))
def q_cast_features(spark, sf_dir):
    df = fill_missing_numeric(training_set(spark, sf_dir))
    return cast_features(df, FEATURES)


# ---------------------------------------------------------------------------- M2, M3


_HASH_SQL = "cast(('0x' || substr(md5(cast(CUST_NUM as varchar)), 1, 8)) as bigint) % 100"


@register("split_by_hash", "M2", sg.render(_train_ctes(), f"""
select CUST_NUM, YEAR, MONTH, TARGET_CHURN,
  case when {_HASH_SQL} < 70 then 'train' else 'test' end as SPLIT
from labelled"""))
def q_split_by_hash(spark, sf_dir):
    df = training_set(spark, sf_dir).select("CUST_NUM", "YEAR", "MONTH", "TARGET_CHURN")
    return lb.split_by_hash(df)


@register("split_by_time", "M3", sg.render(_train_ctes(), """
select CUST_NUM, YEAR, MONTH, TARGET_CHURN,
  case when YEAR * 12 + MONTH - 1 > (select max(YEAR * 12 + MONTH - 1) from labelled) - 1
       then 'test' else 'train' end as SPLIT
from labelled"""))
def q_split_by_time(spark, sf_dir):
    df = training_set(spark, sf_dir).select("CUST_NUM", "YEAR", "MONTH", "TARGET_CHURN")
    return lb.split_by_time(df, 1)


# ---------------------------------------------------------------------------- M9, M10


def _propensity_sql(weights: dict[str, float], quantile: float = CHURN_QUANTILE) -> str:
    ws = list(weights.items())
    stats = ", ".join(f"avg({c}) as mu_{i}, stddev_pop({c}) as sd_{i}" for i, (c, _) in enumerate(ws))
    raw = " + ".join(f"{w} * (({c} - mu_{i}) / (case when sd_{i} = 0 then 1.0 else sd_{i} end))"
                     for i, (c, w) in enumerate(ws))
    ctes = _train_ctes() + [
        ("base", _filled("labelled")),
        ("st", f"select YEAR, MONTH, {stats} from base group by YEAR, MONTH"),
        ("sc", f"select b.CUST_NUM, b.YEAR, b.MONTH, {raw} as raw from base b join st using (YEAR, MONTH)"),
        ("mm", "select YEAR, MONTH, min(raw) as lo, max(raw) as hi from sc group by YEAR, MONTH"),
        ("s2", """select sc.CUST_NUM, sc.YEAR, sc.MONTH,
            (raw - lo) / (case when hi - lo = 0 then 1.0 else hi - lo end) as S
          from sc join mm using (YEAR, MONTH)"""),
        ("th", f"select YEAR, MONTH, quantile_cont(S, {quantile}) as thr from s2 group by YEAR, MONTH"),
    ]
    return sg.render(ctes, """
select CUST_NUM, YEAR, MONTH, round(S, 6) as PROPENSITY_SCORE, cast(S >= thr as integer) as TARGET
from s2 join th using (YEAR, MONTH)""")


def _propensity(spark, sf_dir, weights):
    df = fill_missing_numeric(training_set(spark, sf_dir))
    out = lb.propensity_label(df, weights, CHURN_QUANTILE, ("YEAR", "MONTH"))
    return out.select("CUST_NUM", "YEAR", "MONTH", F.round("PROPENSITY_SCORE", 6).alias("PROPENSITY_SCORE"),
                      "TARGET")


@register("propensity_label", "M9", _propensity_sql(CHURN_WEIGHTS))
def q_propensity_label(spark, sf_dir):
    return _propensity(spark, sf_dir, CHURN_WEIGHTS)


@register("propensity_label_sport", "M9", _propensity_sql(SPORT_WEIGHTS))
def q_propensity_label_sport(spark, sf_dir):
    return _propensity(spark, sf_dir, SPORT_WEIGHTS)


@register("propensity_label_cinema", "M9", _propensity_sql(CINEMA_WEIGHTS))
def q_propensity_label_cinema(spark, sf_dir):
    return _propensity(spark, sf_dir, CINEMA_WEIGHTS)


_FLAG_EVENTS = {f"{k.lower()}_target": v for k, v in lb.TARGET_EVENTS.items()}


def _unpivot_sql() -> str:
    flags = ", ".join(f"max(case when EVENT_TYPE = '{ev}' then 1 else 0 end) as {col}"
                      for col, ev in _FLAG_EVENTS.items())
    longs = "\nunion all\n".join(f"select CUST_NUM, '{ev}' as EVENT_TYPE, date as DATE from w where {col} = 1"
                                 for col, ev in _FLAG_EVENTS.items())
    ctes = sg.fixture_ctes("requests") + [
        _ALL_REQ,
        ("w", f"select CUST_NUM, make_date(YEAR, MONTH, 1) as date, {flags} from req_all group by CUST_NUM, YEAR, MONTH"),
        ("l", longs)]
    return sg.render(ctes, "select * from l where DATE < cast((select max(date) from w) - 15 as date)")


@register("unpivot_requests", "M10", _unpivot_sql())
def q_unpivot_requests(spark, sf_dir):
    wide = lb.wide_request_flags(all_requests(spark, sf_dir))
    return lb.unpivot_requests(wide, _FLAG_EVENTS, "date", 15)
