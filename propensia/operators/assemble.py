"""Training and scoring dataset assembly.

TV and internet are full-joined with USING semantics, so the keys of the
result are coalesced (rows present in only one side keep their customer id,
H2). The remaining tables are left-joined on the same three keys. Every input
has at most one row per (customer, month) except requests (H5), so none of
these joins fans out except the requests join, which is kept only where the
reference's behaviour is asked for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import INTERNET, JOURNEY_SELECTED, TV, usage_feature_columns

JOIN_KEYS = ["CUST_NUM", "YEAR", "MONTH"]
OUT_KEYS = ["CUST_NUM", "MONTH", "YEAR"]
# Feature columns kept by the assembled datasets.
MOBILE_COLUMNS = ["AMOUNT_OUT_OF_BUNDLE_L3M", "NB_DAYS_OUT_OF_BUNDLE_L3M"]
SOCIO_SELECTED = ["AVG_CUST_AGE", "AVG_NB_DAYS_INTERNET_LINE", "AVG_NB_DAYS_TV_LINE",
                  "AVG_NB_MOBILE_SUBS"]


def feature_columns_in_order() -> list[str]:
    return (usage_feature_columns(INTERNET) + usage_feature_columns(TV) + MOBILE_COLUMNS
            + SOCIO_SELECTED + JOURNEY_SELECTED)


def usage_full_join(tv: DataFrame, internet: DataFrame) -> DataFrame:
    """TV FULL JOIN internet on (CUST_NUM, YEAR, MONTH), keys coalesced."""
    return tv.join(internet, on=JOIN_KEYS, how="full")


def _left(df: DataFrame, other: DataFrame, cols: list[str]) -> DataFrame:
    return df.join(other.select(*JOIN_KEYS, *cols), on=JOIN_KEYS, how="left")


def assemble(tv: DataFrame, internet: DataFrame, mobile: DataFrame, socio: DataFrame,
             journeys: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """J6 (with ``requests``) / J7 (without): one row per customer-month of
    usage, 58 feature and key columns, plus EVENT_TYPE for J6.

    Same rows as ``TV FULL JOIN internet LEFT JOIN socio LEFT JOIN journeys``,
    computed as a union and one aggregate: every input has at most one row
    per key, so ``max`` per column picks that row's value, and a flag keeps
    the keys present in TV or internet. The inputs come out of aggregates
    hash-partitioned on the same keys, and the union keeps that
    partitioning, so the merge adds no shuffle (the join chain re-shuffles
    after the full join, whose coalesced keys Spark cannot track). Mobile is
    keyed by customer only (its month is the customer's latest), so it is
    left-joined after the merge; only its narrow rows move.
    """
    tv_cols, it_cols = usage_feature_columns(TV), usage_feature_columns(INTERNET)
    parts = [(tv, tv_cols, 1), (internet, it_cols, 1), (socio, SOCIO_SELECTED, 0),
             (journeys, JOURNEY_SELECTED, 0)]
    tagged = [df.select(*OUT_KEYS, *cols, F.lit(flag).alias("_usage")) for df, cols, flag in parts]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    value_cols = tv_cols + it_cols + SOCIO_SELECTED + JOURNEY_SELECTED
    merged = (merged.groupBy(*OUT_KEYS)
              .agg(*[F.max(c).alias(c) for c in value_cols], F.max("_usage").alias("_usage"))
              .where(F.col("_usage") == 1).drop("_usage"))
    df = _left(merged, mobile, MOBILE_COLUMNS)
    cols = OUT_KEYS + feature_columns_in_order()
    if requests is not None:
        df = requests_left_join(df, requests)
        cols.append("EVENT_TYPE")
    return df.select(*cols)


def assemble_by_joins(tv: DataFrame, internet: DataFrame, mobile: DataFrame, socio: DataFrame,
                      journeys: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """The same result as ``assemble`` written as the reference's join chain
    (kept for comparison and tests)."""
    df = usage_full_join(tv, internet)
    df = _left(df, mobile, MOBILE_COLUMNS)
    df = _left(df, socio, SOCIO_SELECTED)
    df = _left(df, journeys, JOURNEY_SELECTED)
    cols = OUT_KEYS + feature_columns_in_order()
    if requests is not None:
        df = requests_left_join(df, requests)
        cols.append("EVENT_TYPE")
    return df.select(*cols)


def requests_left_join(df: DataFrame, requests: DataFrame, chunk: int = 4096) -> DataFrame:
    """Left join of raw request rows; several requests in one month repeat
    the feature row (the reference's behaviour).

    A customer-month may hold a large share of all requests, and a plain
    join would then produce all of its copies in one task. Requests are
    counted per (key, event type) first (map-side combined) and every count is
    cut into chunks of at most ``chunk`` copies, so a joined row stands for a
    bounded number of copies. The rows are dealt out by key, type and chunk
    before they expand. One plan serves every input; the result holds every copy.
    """
    counts = requests.groupBy(*JOIN_KEYS, "EVENT_TYPE").agg(F.count(F.lit(1)).alias("_n"))
    last_chunk = F.floor((F.col("_n") - 1) / chunk).cast("long")
    chunks = counts.withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk))) \
        .withColumn("_n", F.least(F.lit(chunk).cast("long"), F.col("_n") - F.col("_c") * chunk))
    joined = df.join(chunks, on=JOIN_KEYS, how="left").withColumn("_n", F.coalesce(F.col("_n"), F.lit(1).cast("long")))
    cols = [c for c in joined.columns if c not in ("_n", "_c")]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = joined.repartition(parts, *JOIN_KEYS, "EVENT_TYPE", "_c")
    return dealt.select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_i")).drop("_i")
