"""Raw-source fixtures derived from the driver's read-only TPC-H-style tables.

The engine itself reads the six event sources with ``sources.io.scan_typed``;
these views stand in for them on the test data. Each fixture exists twice:
as a Spark DataFrame (below) and as DuckDB SQL (``FIXTURE_SQL``) so that the
oracle can rebuild the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed category domains (values must equal the reference's column names).
WEBSITE_TYPES = ["CYCLING", "DISNEY", "FOOTBALL", "GAMING", "KIDS", "NETFLIX",
                 "PRICE_COMPARATOR", "SOCIAL_MEDIA", "TELCO"]
TV_PROGRAMS = ["CULTURE", "CYCLING", "DOCUMENTARIES", "FOOTBALL", "MOVIES"]
CONTACT_TYPES = ["ADMINISTRATIVE_ISSUES", "COMPLAINTS", "TECHNICAL_ISSUES"]
REQUEST_TYPES = ["CHURN REQUEST", "SPORT REQUEST", "CINEMA REQUEST"]
MODEL_TYPES = ["CHURN", "SPORT", "CINEMA"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: list[str], index_expr: str) -> F.Column:
    arr = "array(" + ", ".join(f"'{v}'" for v in values) + ")"
    return F.expr(f"element_at({arr}, cast({index_expr} as int) + 1)")


def _line_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = (_table(spark, sf_dir, "lineitem")
          .select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity"))
    od = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(od, li.l_orderkey == od.o_orderkey)


def internet(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _line_orders(spark, sf_dir)
    return j.select(
        F.col("o_custkey").alias("CUST_NUM"), F.col("o_orderdate").alias("EVT_DT"),
        _pick(WEBSITE_TYPES, "l_partkey % 9").alias("WEBSITE_TYPE"),
        (F.col("l_quantity").cast("bigint") * 60).alias("DURATION"))


def tv(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _line_orders(spark, sf_dir)
    return j.select(
        F.col("o_custkey").alias("CUST_NUM"), F.col("o_orderdate").alias("EVT_DT"),
        _pick(TV_PROGRAMS, "l_suppkey % 5").alias("TV_PROGRAM"),
        (F.col("l_quantity").cast("bigint") * 30).alias("DURATION"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders")


def mobile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).selectExpr("o_custkey as CUST_NUM", "o_orderdate as EVT_DT",
                                             "o_orderkey % 50 as OUT_OF_BUNDLE")


def journeys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_orders(spark, sf_dir)
            .select(F.col("o_custkey").alias("CUST_NUM"), F.col("o_orderdate").alias("EVT_DT"),
                    _pick(CONTACT_TYPES, "o_orderkey % 3").alias("CONTACT_TYPE"),
                    F.expr("o_orderkey % 4").alias("NB_CONTACTS")))


def socio_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderdate")
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .selectExpr("o_custkey as CUST_NUM", "o_orderdate as EVT_DT",
                        "18 + c_custkey % 70 as CUST_AGE",
                        "cast(c_nationkey % 4 as bigint) as NB_MOBILE_SUBS",
                        "30 + o_orderkey % 900 as NB_DAYS_INTERNET_LINE",
                        "30 + o_orderkey % 700 as NB_DAYS_TV_LINE"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_orders(spark, sf_dir)
            .where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"))
            .selectExpr("o_custkey as CUST_NUM", "o_orderdate as EVT_DT",
                        "case o_orderpriority when '1-URGENT' then 'CHURN REQUEST' "
                        "when '2-HIGH' then 'SPORT REQUEST' else 'CINEMA REQUEST' end as EVENT_TYPE"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic scored rows for evaluation, tiles and the union fact."""
    return _orders(spark, sf_dir).selectExpr(
        "o_orderkey as ROW_ID", "o_custkey as CUST_NUM",
        "year(o_orderdate) as YEAR", "month(o_orderdate) as MONTH",
        "case o_orderkey % 3 when 0 then 'SPORT' when 1 then 'CHURN' else 'CINEMA' end as MODEL_TYPE",
        "case when (o_orderkey * 7919) % 10007 + (o_orderkey * 104729) % 5003 > 11000 "
        "then 1 else 0 end as TARGET",
        "cast(((o_orderkey * 7919) % 10007 - ((o_orderkey * 7919) % 10007) % 10) as double)"
        " / 10007 as y_proba")


def _customer_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_customer_nation(spark, sf_dir).where("c_custkey % 10 <> 9")
            .selectExpr("c_custkey as cust_num", "c_name as first_name", "n_name as country",
                        "c_mktsegment as city",
                        "date_add(date '1940-01-01', cast(c_custkey * 37 % 24000 as int)) as birth_date"))


def customer_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_customer_nation(spark, sf_dir).where("c_custkey % 10 in (0, 9)")
            .selectExpr("c_custkey as cust_num", "concat(c_name, '-v2') as first_name",
                        "n_name as country",
                        "case when c_custkey % 20 = 0 then cast(null as string) else c_mktsegment end as city",
                        "date_add(date '1940-01-01', cast(c_custkey * 37 % 24000 as int)) as birth_date"))


EVENT_SOURCES = {
    "internet": internet, "tv": tv, "mobile": mobile, "journeys": journeys,
    "socio_demo": socio_demo, "requests": requests,
}


def _dd_pick(values: list[str], index_expr: str) -> str:
    lst = "list_value(" + ", ".join(f"'{v}'" for v in values) + ")"
    return f"list_extract({lst}, cast({index_expr} as integer) + 1)"


# DuckDB text of every fixture, used as CTEs by the oracle SQL. Casts of
# doubles to integers go through trunc() because DuckDB rounds where Spark
# truncates.
FIXTURE_SQL = {
    "internet": f"""select o.o_custkey as CUST_NUM, o.o_orderdate as EVT_DT,
        {_dd_pick(WEBSITE_TYPES, 'l.l_partkey % 9')} as WEBSITE_TYPE,
        cast(trunc(l.l_quantity) as bigint) * 60 as DURATION
      from lineitem l join orders o on l.l_orderkey = o.o_orderkey""",
    "tv": f"""select o.o_custkey as CUST_NUM, o.o_orderdate as EVT_DT,
        {_dd_pick(TV_PROGRAMS, 'l.l_suppkey % 5')} as TV_PROGRAM,
        cast(trunc(l.l_quantity) as bigint) * 30 as DURATION
      from lineitem l join orders o on l.l_orderkey = o.o_orderkey""",
    "mobile": """select o_custkey as CUST_NUM, o_orderdate as EVT_DT, o_orderkey % 50 as OUT_OF_BUNDLE
      from orders""",
    "journeys": f"""select o_custkey as CUST_NUM, o_orderdate as EVT_DT,
        {_dd_pick(CONTACT_TYPES, 'o_orderkey % 3')} as CONTACT_TYPE,
        o_orderkey % 4 as NB_CONTACTS
      from orders""",
    "socio_demo": """select o.o_custkey as CUST_NUM, o.o_orderdate as EVT_DT,
        18 + c.c_custkey % 70 as CUST_AGE,
        cast(c.c_nationkey % 4 as bigint) as NB_MOBILE_SUBS,
        30 + o.o_orderkey % 900 as NB_DAYS_INTERNET_LINE,
        30 + o.o_orderkey % 700 as NB_DAYS_TV_LINE
      from orders o join customer c on o.o_custkey = c.c_custkey""",
    "requests": """select o_custkey as CUST_NUM, o_orderdate as EVT_DT,
        case o_orderpriority when '1-URGENT' then 'CHURN REQUEST'
                             when '2-HIGH' then 'SPORT REQUEST'
                             else 'CINEMA REQUEST' end as EVENT_TYPE
      from orders where o_orderpriority in ('1-URGENT','2-HIGH','3-MEDIUM')""",
    "scored": """select o_orderkey as ROW_ID, o_custkey as CUST_NUM,
        cast(year(o_orderdate) as integer) as YEAR, cast(month(o_orderdate) as integer) as MONTH,
        case o_orderkey % 3 when 0 then 'SPORT' when 1 then 'CHURN' else 'CINEMA' end as MODEL_TYPE,
        case when (o_orderkey * 7919) % 10007 + (o_orderkey * 104729) % 5003 > 11000
             then 1 else 0 end as TARGET,
        cast(((o_orderkey * 7919) % 10007 - ((o_orderkey * 7919) % 10007) % 10) as double)
          / 10007 as y_proba
      from orders""",
    "customers": """select c.c_custkey as cust_num, c.c_name as first_name, n.n_name as country,
        c.c_mktsegment as city,
        cast(date '1940-01-01' + cast(c.c_custkey * 37 % 24000 as integer) as date) as birth_date
      from customer c join nation n on c.c_nationkey = n.n_nationkey
      where c.c_custkey % 10 <> 9""",
    "customer_updates": """select c.c_custkey as cust_num, concat(c.c_name, '-v2') as first_name,
        n.n_name as country,
        case when c.c_custkey % 20 = 0 then cast(null as varchar) else c.c_mktsegment end as city,
        cast(date '1940-01-01' + cast(c.c_custkey * 37 % 24000 as integer) as date) as birth_date
      from customer c join nation n on c.c_nationkey = n.n_nationkey
      where c.c_custkey % 10 in (0, 9)""",
}


def with_fixtures(names: list[str], body: str, extra_ctes: list[tuple[str, str]] | None = None) -> str:
    """Wrap ``body`` in a WITH clause defining the named fixtures (and extra CTEs)."""
    ctes = [f"{n} as ({FIXTURE_SQL[n]})" for n in names]
    ctes += [f"{n} as ({q})" for n, q in (extra_ctes or [])]
    return "with " + ",\n".join(ctes) + "\n" + body
