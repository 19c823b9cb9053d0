"""DuckDB text of the feature tables, used by the oracle SQL of the catalog.

The oracle is an independent formulation: plain window functions
(``percent_rank``, ``rank``, ``row_number``) and ``count(distinct …)`` where
the Spark side uses range-partitioned ranks and day masks. Integer casts go
through ``trunc`` because DuckDB rounds where Spark truncates.
"""

from __future__ import annotations

from ..operators.features import (INTERNET, JOURNEY_SELECTED, SOCIO_COLUMNS, TV, UsageSpec,
                                  usage_feature_columns)
from ..sources.fixtures import CONTACT_TYPES

Cte = tuple[str, str]


def month_ctes(src: str) -> list[Cte]:
    """``<src>_mx`` holds M (anchor month) and A (latest month <= M-2)."""
    return [
        (f"{src}_mo", f"select distinct year(EVT_DT) * 12 + month(EVT_DT) - 1 as mi from {src}"),
        (f"{src}_mx", f"""select (select max(mi) from {src}_mo) as M,
              (select max(mi) from {src}_mo where mi <= (select max(mi) from {src}_mo) - 2) as A"""),
    ]


def window_pred(src: str, mode: str, kind: str) -> str:
    """Month predicate on ``mi`` for a source; kind = 'l3m' or 'all'."""
    mx = f"(select {{c}} from {src}_mx)"
    if mode == "score":
        return f"mi = {mx.format(c='M')} - 1"
    if kind == "l3m":
        return f"mi between {mx.format(c='A')} - 2 and {mx.format(c='A')}"
    return f"mi <= {mx.format(c='M')} - 2"


def _std(src: str, mode: str, kind: str, cols: str) -> str:
    return f"""select {cols}, cast(EVT_DT as date) as d,
          cast(month(EVT_DT) as integer) as MONTH, cast(year(EVT_DT) as integer) as YEAR
        from (select *, year(EVT_DT) * 12 + month(EVT_DT) - 1 as mi from {src})
        where {window_pred(src, mode, kind)}"""


def usage_ctes(spec: UsageSpec, src: str, mode: str, name: str) -> list[Cte]:
    cat = spec.category_col
    agg = f"""select CUST_NUM, {cat}, MONTH, YEAR,
          cast(sum(DURATION) as bigint) as DURATION_L3M,
          count(distinct d) as NB_DAYS_USAGE_L3M
        from ({_std(src, mode, 'l3m', f'CUST_NUM, {cat}, DURATION')})
        group by CUST_NUM, {cat}, MONTH, YEAR"""
    rk = f"""select *, cast(trunc(percent_rank() over (partition by {cat}, MONTH, YEAR
          order by DURATION_L3M) * 99 + 1) as integer) as RK from {name}_agg"""
    cols = []
    for c in spec.categories:
        s, d, r = (f"{spec.prefix}_DURATION_{c}_L3M_SECONDES", f"{spec.prefix}_DURATION_{c}_L3M_DAYS",
                   f"{spec.prefix}_RANK_{c}_L3M")
        cols += [f"max(case when {cat} = '{c}' then DURATION_L3M end) as {s}",
                 f"max(case when {cat} = '{c}' then NB_DAYS_USAGE_L3M end) as {d}",
                 f"max(case when {cat} = '{c}' then RK end) as {r}"]
    piv = f"select CUST_NUM, MONTH, YEAR, {', '.join(cols)} from {name}_rk group by CUST_NUM, MONTH, YEAR"
    return month_ctes(src) + [(f"{name}_agg", agg), (f"{name}_rk", rk), (name, piv)]


def journey_ctes(src: str, mode: str, name: str) -> list[Cte]:
    detail = f"""select CUST_NUM, CONTACT_TYPE, MONTH, YEAR,
          cast(sum(NB_CONTACTS) as bigint) as AMT, count(distinct d) as NDAYS
        from ({_std(src, mode, 'l3m', 'CUST_NUM, CONTACT_TYPE, NB_CONTACTS')})
        group by CUST_NUM, CONTACT_TYPE, MONTH, YEAR"""
    cols = []
    for c in CONTACT_TYPES:
        cols += [f"max(case when CONTACT_TYPE = '{c}' then AMT end) as AMOUNT_OF_CONTACT_{c}_L3M",
                 f"max(case when CONTACT_TYPE = '{c}' then NDAYS end) as JOURNEY_DURATION_{c}_L3M_DAYS"]
    piv = f"select CUST_NUM, MONTH, YEAR, {', '.join(cols)} from {name}_det group by CUST_NUM, MONTH, YEAR"
    glob = f"""select CUST_NUM, MONTH, YEAR, count(distinct d) as TOTAL_NUMBER_OF_JOURNEYS_L3M,
          cast(sum(NB_CONTACTS) as bigint) as TOTAL_NUMBER_OF_CONTACTS_L3M
        from ({_std(src, mode, 'l3m', 'CUST_NUM, CONTACT_TYPE, NB_CONTACTS')})
        group by CUST_NUM, MONTH, YEAR"""
    res = f"""select p.*, g.TOTAL_NUMBER_OF_JOURNEYS_L3M, g.TOTAL_NUMBER_OF_CONTACTS_L3M
        from {name}_piv p left join {name}_glob g using (CUST_NUM, MONTH, YEAR)"""
    return month_ctes(src) + [(f"{name}_det", detail), (f"{name}_piv", piv),
                              (f"{name}_glob", glob), (name, res)]


def mobile_ctes(src: str, mode: str, name: str) -> list[Cte]:
    per = f"""select CUST_NUM, MONTH, YEAR, cast(sum(OUT_OF_BUNDLE) as bigint) as A,
          count(distinct d) as N
        from ({_std(src, mode, 'l3m', 'CUST_NUM, OUT_OF_BUNDLE')})
        group by CUST_NUM, MONTH, YEAR"""
    res = f"""select CUST_NUM, cast(sum(A) as bigint) as AMOUNT_OUT_OF_BUNDLE_L3M,
          cast(sum(N) as bigint) as NB_DAYS_OUT_OF_BUNDLE_L3M,
          cast(max(YEAR * 12 + MONTH - 1) % 12 + 1 as integer) as MONTH,
          cast(max(YEAR * 12 + MONTH - 1) // 12 as integer) as YEAR
        from {name}_per group by CUST_NUM"""
    return month_ctes(src) + [(f"{name}_per", per), (name, res)]


def socio_ctes(src: str, mode: str, name: str) -> list[Cte]:
    cols = ", ".join(f"avg({c}) as AVG_{c}" for c in SOCIO_COLUMNS)
    res = f"""select CUST_NUM, MONTH, YEAR, {cols}
        from ({_std(src, mode, 'all', 'CUST_NUM, ' + ', '.join(SOCIO_COLUMNS))})
        group by CUST_NUM, MONTH, YEAR"""
    return month_ctes(src) + [(name, res)]


def requests_ctes(src: str, mode: str, name: str) -> list[Cte]:
    res = f"""select CUST_NUM, EVENT_TYPE, MONTH, YEAR
        from ({_std(src, mode, 'all', 'CUST_NUM, EVENT_TYPE')})"""
    return month_ctes(src) + [(name, res)]


def dedupe_ctes(ctes: list[Cte]) -> list[Cte]:
    seen, out = set(), []
    for n, q in ctes:
        if n not in seen:
            seen.add(n)
            out.append((n, q))
    return out


def render(ctes: list[Cte], body: str) -> str:
    from ..sources.fixtures import FIXTURE_SQL
    ctes = dedupe_ctes(ctes)
    parts = [f"{n} as ({q})" for n, q in ctes]
    return "with " + ",\n".join(parts) + "\n" + body


def fixture_ctes(*names: str) -> list[Cte]:
    from ..sources.fixtures import FIXTURE_SQL
    return [(n, FIXTURE_SQL[n]) for n in names]


# Column lists of the assembled datasets (J6/J7) in output order.
TV_COLUMNS = usage_feature_columns(TV)
INTERNET_COLUMNS = usage_feature_columns(INTERNET)
MOBILE_COLUMNS = ["AMOUNT_OUT_OF_BUNDLE_L3M", "NB_DAYS_OUT_OF_BUNDLE_L3M"]
SOCIO_SELECTED = ["AVG_CUST_AGE", "AVG_NB_DAYS_INTERNET_LINE", "AVG_NB_DAYS_TV_LINE", "AVG_NB_MOBILE_SUBS"]


def feature_set_ctes(mode: str) -> list[Cte]:
    ctes = fixture_ctes("internet", "tv", "mobile", "journeys", "socio_demo")
    ctes += usage_ctes(INTERNET, "internet", mode, "f_internet")
    ctes += usage_ctes(TV, "tv", mode, "f_tv")
    ctes += mobile_ctes("mobile", mode, "f_mobile")
    ctes += socio_ctes("socio_demo", mode, "f_socio")
    ctes += journey_ctes("journeys", mode, "f_journeys")
    return ctes


def assembled_select(with_requests: bool) -> str:
    """Full join TV x internet on coalesced keys, left joins of the rest."""
    cols = ["coalesce(t.CUST_NUM, i.CUST_NUM) as CUST_NUM", "coalesce(t.MONTH, i.MONTH) as MONTH",
            "coalesce(t.YEAR, i.YEAR) as YEAR"]
    cols += [f"i.{c}" for c in INTERNET_COLUMNS] + [f"t.{c}" for c in TV_COLUMNS]
    cols += [f"m.{c}" for c in MOBILE_COLUMNS] + [f"s.{c}" for c in SOCIO_SELECTED]
    cols += [f"j.{c}" for c in JOURNEY_SELECTED]
    if with_requests:
        cols.append("r.EVENT_TYPE")
    k = "coalesce(t.{c}, i.{c})"
    on = " and ".join(f"{k.format(c=c)} = {{a}}.{c}" for c in ("CUST_NUM", "YEAR", "MONTH"))
    sql = f"""select {', '.join(cols)}
      from f_tv t full join f_internet i
        on t.CUST_NUM = i.CUST_NUM and t.YEAR = i.YEAR and t.MONTH = i.MONTH
      left join f_mobile m on {on.format(a='m')}
      left join f_socio s on {on.format(a='s')}
      left join f_journeys j on {on.format(a='j')}"""
    if with_requests:
        sql += f"\n      left join f_requests r on {on.format(a='r')}"
    return sql
