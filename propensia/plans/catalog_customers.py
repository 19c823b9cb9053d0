"""Queries for the customer dimension, the date dimension, the source and
sink connectors, and the dataset profile."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.columns import fill_missing_numeric
from ..operators import customers as cu
from ..operators.assemble import feature_columns_in_order
from ..operators import profile as pr
from ..session import scratch_path, stage
from ..sources import commits, io
from ..sources.fixtures import EVENT_SOURCES, customer_updates, customers, internet, scored
from . import sqlgen as sg
from .catalog import register
from .catalog_assembly import _train_ctes, _filled, training_set
from .catalog_evaluation import union_fact, _BASE as _EVAL_BASE, _UNION

_CUST = sg.fixture_ctes("customers", "customer_updates")
_ATTRS = ["first_name", "country", "city", "birth_date"]


# ---------------------------------------------------------------------------- J8-J10


@register("customers_update", "J8", sg.render(_CUST, "select t.cust_num, " + ", ".join(
    f"case when u.cust_num is not null then u.{c} else t.{c} end as {c}" for c in _ATTRS) + """
from customers t left join customer_updates u on t.cust_num = u.cust_num"""))
def q_customers_update(spark, sf_dir):
    return cu.customers_update(customers(spark, sf_dir), customer_updates(spark, sf_dir))


@register("customers_new_only", "J9", sg.render(_CUST, """
select * from customer_updates where cust_num not in (select cust_num from customers)"""))
def q_customers_new_only(spark, sf_dir):
    return cu.customers_new_only(customers(spark, sf_dir), customer_updates(spark, sf_dir))


@register("customers_not_in", "J9", sg.render(_CUST + [
    ("staged", "select * from customer_updates union all select null, 'no id', null, null, null"),
    ("with_null", "select cust_num from customers union all select null"),
    ("cases", """select 'no null' as list, * from staged where cust_num not in (select cust_num from customers)
      union all select 'a null', * from staged where cust_num not in (select cust_num from with_null)
      union all select 'empty', * from staged where cust_num not in (select cust_num from customers where cust_num is null)""")],
    "select * from cases"))
def q_customers_not_in(spark, sf_dir):
    """``NOT IN`` of a load with a null id against a list without null, with one, and an empty one."""
    known, load = customers(spark, sf_dir), customer_updates(spark, sf_dir)
    load = load.unionByName(load.limit(0).sparkSession.createDataFrame([(None, "no id", None, None, None)], load.schema))
    null = spark.createDataFrame([(None,)], known.select("cust_num").schema)
    lists = {"no null": known.select("cust_num"), "a null": known.select("cust_num").unionByName(null), "empty": known.select("cust_num").where("cust_num is null")}
    return reduce(DataFrame.unionByName, [cu.not_in(load, ids).select(F.lit(name).alias("list"), "*") for name, ids in lists.items()])


@register("customers_upsert", "J10", sg.render(_CUST, "select coalesce(u.cust_num, t.cust_num) as cust_num, " + ", ".join(
    f"case when u.cust_num is not null then u.{c} else t.{c} end as {c}" for c in _ATTRS) + """
from customers t full join customer_updates u on t.cust_num = u.cust_num"""))
def q_customers_upsert(spark, sf_dir):
    return cu.customers_upsert(customers(spark, sf_dir), customer_updates(spark, sf_dir))


# ---------------------------------------------------------------------------- J11, J12, D1


@register("fact_customer_star", "J11", sg.render(_EVAL_BASE + [_UNION] + sg.fixture_ctes("customers"), f"""
select f.*, {', '.join('c.' + a for a in _ATTRS)} from fact f left join customers c on f.CUST_NUM = c.cust_num"""))
def q_fact_customer_star(spark, sf_dir):
    return cu.fact_customer_star(union_fact(spark, sf_dir), customers(spark, sf_dir))


_SCORED_KEYS = sg.fixture_ctes("scored") + sg.fixture_ctes("customers") + [
    ("broken", """select key, unnest(list_filter([case when n_dim = 0 then 'orphan' end, case when n_dim > 1 then 'duplicate_dimension' end,
        case when n_fact > 1 then 'duplicate_fact' end], lambda x: x is not null)) as reason, n_fact, n_dim
      from (select coalesce(f.k, d.k) as key, coalesce(nf, 0) as n_fact, coalesce(nd, 0) as n_dim
            from (select CUST_NUM as k, count(*) as nf from scored where MODEL_TYPE = 'SPORT' group by 1) f
            full join (select cust_num as k, count(*) as nd from (select cust_num from customers union all select cust_num from customers where city = 'BUILDING') group by 1) d
            on f.k = d.k)
      where not (n_dim = 0 and n_fact = 0)""")]


def _scored_facts(spark, sf_dir):
    """The scores of one model, and a dimension in which one market's customers come twice."""
    dim = customers(spark, sf_dir)
    return scored(spark, sf_dir).where("MODEL_TYPE = 'SPORT'"), dim.unionByName(dim.where("city = 'BUILDING'"))


@register("scored_key_check", "J11", sg.render(_SCORED_KEYS, "select * from broken"))
def q_scored_key_check(spark, sf_dir):
    facts, dim = _scored_facts(spark, sf_dir)
    return cu.relationship_check(facts, dim)


@register("scored_customer_star", "J11", sg.render(_SCORED_KEYS, f"""
select s.*, {', '.join('c.' + a for a in _ATTRS)} from scored s left join customers c on s.CUST_NUM = c.cust_num
where s.MODEL_TYPE = 'SPORT' and s.CUST_NUM not in (select key from broken)"""))
def q_scored_customer_star(spark, sf_dir):
    return cu.scored_customer_star(*_scored_facts(spark, sf_dir))[0]


_DATES = ("dates", """select cast(d as date) as Date, cast(year(d) as integer) as Year,
    cast(month(d) as integer) as MonthNo, strftime(d, '%B') as Month,
    cast(quarter(d) as integer) as QuarterNo, 'Qtr ' || cast(quarter(d) as varchar) as Quarter,
    cast(day(d) as integer) as Day
  from (select unnest(generate_series(
          make_date(cast(year(min(birth_date)) as integer), 1, 1),
          make_date(cast(year(max(birth_date)) as integer), 12, 31), interval 1 day)) as d
        from customers)""")


@register("date_dimension", "D1", sg.render(sg.fixture_ctes("customers") + [_DATES], "select * from dates"))
def q_date_dimension(spark, sf_dir):
    return cal.date_dimension(customers(spark, sf_dir), "birth_date")


@register("date_dim_join", "J12", sg.render(sg.fixture_ctes("customers") + [_DATES], """
select c.*, d.Year, d.MonthNo, d.Month, d.QuarterNo, d.Quarter, d.Day
from customers c left join dates d on c.birth_date = d.Date"""))
def q_date_dim_join(spark, sf_dir):
    dim = customers(spark, sf_dir)
    return cu.date_dim_join(dim, cal.date_dimension(dim, "birth_date"))


# ---------------------------------------------------------------------------- S1, S2, S4, S7


@register("scan_typed", "S1", sg.render(sg.fixture_ctes("internet"), "select * from internet"))
def q_scan_typed(spark, sf_dir):
    """Land the internet source in the source system's layout, one folder per
    generation batch (``history``: every day before the last, ``live``: the
    last day), then scan it back with the fixed schema through the one-level
    ``<source>/*/<source>.parquet`` glob."""
    root = scratch_path(spark, "landing")
    events = internet(spark, sf_dir)
    last_day = events.agg(F.max(F.to_date("EVT_DT"))).first()[0]
    live = F.to_date("EVT_DT") == F.lit(last_day)
    for batch, cond in (("history", ~live), ("live", live)):
        events.where(cond).write.mode("overwrite").parquet(f"{root}/internet/{batch}/internet.parquet")
    return io.scan_typed(spark, "internet", root, timestamp_ntz=True)


@register("csv_staging_load", "S2 S6", sg.render(sg.fixture_ctes("customer_updates"), "select * from customer_updates"))
def q_csv_staging_load(spark, sf_dir):
    path = scratch_path(spark, "customers_csv")
    io.write_csv(customer_updates(spark, sf_dir), path)
    return io.load_csv(spark, path)


@register("scan_all_sources", "S1", sg.render(sg.fixture_ctes(*EVENT_SOURCES), " union all ".join(
    f"""select '{name}' as source, count(*) as n_rows, cast(sum(CUST_NUM) as bigint) as sum_cust_num, min(EVT_DT) as first_day, max(EVT_DT) as last_day,
  count(distinct {io.SOURCE_SCHEMAS[name].names[2]}) as n_values from {name}""" for name in EVENT_SOURCES)))
def q_scan_all_sources(spark, sf_dir):
    """All six sources landed in batch folders and scanned back with their fixed schemas, profiled by source."""
    root = scratch_path(spark, "landing-all")
    out = []
    for name, fixture in EVENT_SOURCES.items():
        events = fixture(spark, sf_dir)
        for batch, cond in (("history", "CUST_NUM % 2 = 0"), ("live", "CUST_NUM % 2 = 1")):
            events.where(cond).write.parquet(f"{root}/{name}/{batch}/{name}.parquet")
        found = io.scan_typed(spark, name, root, timestamp_ntz=True)
        out.append(found.agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("n_rows"), F.sum("CUST_NUM").alias("sum_cust_num"), F.min("EVT_DT").alias("first_day"),
                             F.max("EVT_DT").alias("last_day"), F.countDistinct(found.columns[2]).alias("n_values")))
    return reduce(DataFrame.unionByName, out)


# The load's lines as the sending system writes them; some of them don't fit the staging table.
_LINES = """select case when k = 4 then null else cast(c_custkey as varchar) end as customer_id, 'F' || c_custkey as first_name,
    case when k = 3 then 'a last name that is too long' else 'L, ' || c_nationkey end as last_name, case when k = 1 then 'maybe' when c_custkey % 2 = 0 then 'true' else 'false' end as gender,
    n_name as nationality, case when k = 2 then '1990-02-31' when k = 5 then null else '1980-01-' || (10 + c_custkey % 19) end as birth_date,
    c_custkey || ' Main Street' as street_address, c_mktsegment as city, cast(10000 + c_custkey % 9000 as varchar) as postal_code, n_name as country,
    '555-' || c_custkey as phone_number, 'u' || c_custkey || '@example.org' as email_address, k
  from (select *, c_custkey % 40 as k from customer) join nation on c_nationkey = n_nationkey"""


def _staged_files(spark, sf_dir):
    for t in ("customer", "nation"):
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet").createOrReplaceTempView(f"_staging_{t}")
    lines = _LINES.replace("varchar", "string").replace("from customer)", "from _staging_customer)").replace("join nation", "join _staging_nation")
    path = scratch_path(spark, "staging_csv")
    spark.sql(lines).drop("k").write.csv(path)
    return io.load_staging(spark, path)


@register("staging_load", "S2 S6", sg.render([("lines", _LINES)], """
select customer_id, first_name, last_name, cast(gender as boolean) as gender, nationality, cast(birth_date as date) as birth_date, street_address, city, postal_code,
  country, phone_number, email_address from lines where k not in (1, 2, 3, 4)"""))
def q_staging_load(spark, sf_dir):
    return _staged_files(spark, sf_dir)[0]


@register("staging_rejects", "S2 S6", sg.render([("lines", _LINES)], """
select 'u' || c_custkey || '@example.org' as email_address, case k when 1 then 'gender is no boolean' when 2 then 'birth_date is no date'
  when 3 then 'last_name longer than 20' else 'no customer_id' end as reason from (select c_custkey, c_custkey % 40 as k from customer) where k in (1, 2, 3, 4)"""))
def q_staging_rejects(spark, sf_dir):
    return _staged_files(spark, sf_dir)[1].select(F.get_json_object("row", "$.email_address").alias("email_address"), "reason")


@register("table_replace", "S4", sg.render(_CUST, "select coalesce(u.cust_num, t.cust_num) as cust_num, " + ", ".join(
    f"case when u.cust_num is not null then u.{c} else t.{c} end as {c}" for c in _ATTRS) + """
from customers t full join customer_updates u on t.cust_num = u.cust_num"""))
def q_table_replace(spark, sf_dir):
    """The dimension is replaced by the upsert that reads it, by one commit."""
    root = scratch_path(spark, "dim_versions")
    commits.replace_table(customers(spark, sf_dir), root)
    return commits.replace_table(cu.customers_upsert(commits.read_snapshot(spark, root), customer_updates(spark, sf_dir)), root)


def _table_name(prefix: str, path: str) -> str:
    return prefix + "_" + re.sub(r"[^0-9a-zA-Z]", "", path)[-10:]


@register("table_roundtrip", "S3 S4 S5", sg.render(sg.fixture_ctes("customers"), "select * from customers"))
def q_table_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "dim_customers")
    return io.save_table(customers(spark, sf_dir), _table_name("dim_customers", path), path=path)


@register("describe_table", "S7", """
select * from (values ('cust_num', 'bigint', null), ('first_name', 'string', null), ('country', 'string', null),
  ('city', 'string', null), ('birth_date', 'date', null)) as t(col_name, data_type, comment)""")
def q_describe_table(spark, sf_dir):
    path = scratch_path(spark, "dim_customers")
    name = _table_name("dim_customers", path)
    io.save_table(customers(spark, sf_dir), name, path=path)
    return io.describe_table(spark, name)


# ---------------------------------------------------------------------------- A7-A9

_LABELLED_COLS = ["CUST_NUM", "MONTH", "YEAR"] + feature_columns_in_order() + ["TARGET_CHURN"]


def _summary_sql() -> str:
    casts = ", ".join(f"cast({c} as double) as {c}" for c in _LABELLED_COLS)
    ctes = _train_ctes() + [
        ("num", f"select {casts} from labelled"),
        ("lng", f"unpivot num on {', '.join(_LABELLED_COLS)} into name column_name value v"),
    ]
    return sg.render(ctes, """
select column_name, count(v) as count, round(avg(v), 6) as mean, round(stddev_samp(v), 6) as stddev,
  min(v) as min, round(quantile_cont(v, 0.25), 6) as p25, round(quantile_cont(v, 0.5), 6) as p50,
  round(quantile_cont(v, 0.75), 6) as p75, max(v) as max
from lng group by column_name""")


@register("summary_stats", "A7", _summary_sql())
def q_summary_stats(spark, sf_dir):
    out = pr.summary_stats(training_set(spark, sf_dir))
    return out.select(F.col("column").alias("column_name"), "count", "mean", "stddev", "min",
                      *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")], "max")


RANK_ERROR = 0.001


@register("summary_stats_approx", "A7", sg.render(_train_ctes() + [
    ("num", f"select {', '.join(f'cast({c} as double) as {c}' for c in _LABELLED_COLS)} from labelled"),
    ("lng", f"unpivot num on {', '.join(_LABELLED_COLS)} into name column_name value v"),
    ("st", """select column_name, count(v) as count, round(avg(v), 6) as mean, round(stddev_samp(v), 6) as stddev, min(v) as min, max(v) as max
      from lng group by column_name""")], "select st.*, quantile, true as WITHIN_ERROR from st cross join (select unnest([0.25, 0.5, 0.75]) as quantile)"))
def q_summary_stats_approx(spark, sf_dir):
    """The sketch's quartiles are held against the exact ranks of their values."""
    data = stage(training_set(spark, sf_dir), "approx-in")
    summary = stage(pr.summary_stats_approx(data, _LABELLED_COLS, RANK_ERROR), "approx-summary")
    errors = pr.quantile_rank_errors(data, summary)
    return summary.join(errors, "column").select(F.col("column").alias("column_name"), "count", "mean", "stddev", "min", "max", "quantile",
                                                 (F.col("rank_error") <= RANK_ERROR + 1 / F.col("count")).alias("WITHIN_ERROR"))


@register("null_share", "A8", sg.render(_train_ctes(), "select " + ", ".join(
    f"avg(case when {c} is null then 1 else 0 end) as {c}" for c in _LABELLED_COLS) + " from labelled"))
def q_null_share(spark, sf_dir):
    return pr.null_share(training_set(spark, sf_dir))


def _corr_sql() -> str:
    cols = _LABELLED_COLS
    items = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            items.append(f"{{'col1': '{a}', 'col2': '{b}', 'corr': case when var_pop({a}) > 0 and var_pop({b}) > 0 "
                         f"then round(corr({a}, {b}), 2) end}}")
    ctes = _train_ctes() + [("base", _filled("labelled")),
                            ("lst", f"select [{', '.join(items)}] as l from base")]
    return sg.render(ctes, "select unnest(l, recursive := true) from lst")


@register("correlation_pairs", "A9", _corr_sql())
def q_correlation_pairs(spark, sf_dir):
    return pr.correlation_pairs(fill_missing_numeric(training_set(spark, sf_dir)), _LABELLED_COLS)
