"""Customer dimension maintenance and star joins (J8-J12, D1 use).

The upsert is one full outer join on the customer id, so the dimension is
read once and the new snapshot written once (``sources.io.save_table``; with a
Delta sink the same condition drives ``MERGE INTO``). Joins to the dimension
are plain equi-joins: Spark broadcasts the dimension only when its measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` (at planning from file
statistics, or at run time through AQE), and shuffles otherwise.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ID = "cust_num"


def _attrs(target: DataFrame, key: str) -> list[str]:
    return [c for c in target.columns if c != key]


def _staged(staged: DataFrame, key: str) -> DataFrame:
    """The load with at most one row per id. A null id matches nothing and is no
    customer; of several rows for one id the smallest by its attributes counts."""
    attrs = _attrs(staged, key)
    one = staged.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_sk")).agg(F.min(F.struct(*attrs)).alias("_a"))
    return one.select("_sk", *[F.col(f"_a.{c}").alias(f"_s_{c}") for c in attrs])


def customers_update(target: DataFrame, staged: DataFrame, key: str = ID) -> DataFrame:
    """Every target row; matched rows take all staged attributes, nulls
    included (``UPDATE … FROM``). Attributes absent from the load keep their
    value (H10)."""
    s = _staged(staged, key)
    j = target.join(s, target[key] == s["_sk"], "left")
    loaded = set(staged.columns)
    cols = [F.col(key)]
    for c in _attrs(target, key):
        cols.append(F.when(F.col("_sk").isNotNull(), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c)
                    if c in loaded else F.col(c))
    return j.select(*cols)


def customers_new_only(target: DataFrame, staged: DataFrame, key: str = ID,
                       null_aware: bool = False) -> DataFrame:
    """Staged rows whose id is not in the target.

    Anti join on non-null ids; a staged row without id is no customer and is
    not inserted. ``null_aware=True`` is SQL's ``NOT IN``, see ``not_in``.
    """
    if null_aware:
        return not_in(staged, target, key)
    staged = staged.where(F.col(key).isNotNull())
    return staged.join(target.select(key).where(F.col(key).isNotNull()), on=key, how="left_anti")


def not_in(rows: DataFrame, listed: DataFrame, key: str = ID) -> DataFrame:
    """The rows for which ``key NOT IN (select key from listed)`` is true: all of them if
    listed is empty; none if it holds a null; else those with an id that it has not.

    One plan and no job of its own: a shuffled anti join on the key, and beside it one row that
    says whether listed is empty or has a null, joined on a constant (one row is a proven
    size, so it is broadcast). SQL's own null-aware anti join would broadcast the whole list."""
    keys = listed.select(F.col(key).alias("_listed"))
    facts = keys.agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("_listed").isNull()).alias("_nulls")).withColumn("_one", F.lit(1))
    rest = rows.join(keys.where("_listed is not null"), F.col(key) == F.col("_listed"), "left_anti").withColumn("_one", F.lit(1))
    return rest.join(F.broadcast(facts), "_one").where((F.col("_n") == 0) | ((F.col("_nulls") == 0) & F.col(key).isNotNull())).select(*rows.columns)


def customers_upsert(target: DataFrame, staged: DataFrame, key: str = ID) -> DataFrame:
    """Update matched ids, insert new ones, keep the rest, in one full
    outer join; one row per id (target rows without id stay as they are)."""
    s = _staged(staged, key)
    t = target.withColumn("_tk", F.col(key))
    j = t.join(s, t["_tk"] == s["_sk"], "full")
    hit = F.col("_sk").isNotNull()
    loaded = set(staged.columns)
    cols = [F.coalesce(F.col("_sk"), F.col("_tk")).alias(key)]
    for c in _attrs(target, key):
        cols.append(F.when(hit, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in loaded
                    else F.col(c).alias(c))
    return j.select(*cols)


def fact_customer_star(fact: DataFrame, dim: DataFrame, fact_key: str = "CUST_NUM",
                       dim_key: str = ID, attrs: Sequence[str] | None = None) -> DataFrame:
    """Fact rows with the customer attributes (many-to-one, facts without
    a customer keep nulls)."""
    attrs = list(attrs or _attrs(dim, dim_key))
    d = dim.select(F.col(dim_key).alias("_dk"), *attrs)
    return fact.join(d, fact[fact_key] == d["_dk"], "left").drop("_dk")


def relationship_check(fact: DataFrame, dim: DataFrame, fact_key: str = "CUST_NUM", dim_key: str = ID,
                       one_to_one: bool = True) -> DataFrame:
    """The keys that break a relationship between facts and a dimension, with
    the reason and the numbers of rows on both sides: ``duplicate_dimension`` (the dimension has
    the key more than once), ``duplicate_fact`` (one-to-one only), ``orphan`` (no row of the
    dimension) and ``null_key`` (facts without key).

    Both sides are counted per key before they meet, so a hot key is one row in the join."""
    f = fact.groupBy(F.col(fact_key).alias("_key")).agg(F.count(F.lit(1)).alias("n_fact"))
    d = dim.where(F.col(dim_key).isNotNull()).groupBy(F.col(dim_key).alias("_dim")).agg(F.count(F.lit(1)).alias("n_dim"))
    both = f.join(d, F.col("_key") == F.col("_dim"), "full").select(
        F.coalesce("_key", "_dim").alias("key"), F.coalesce("n_fact", F.lit(0)).alias("n_fact"), F.coalesce("n_dim", F.lit(0)).alias("n_dim"))
    reasons = [F.when(F.col("key").isNull(), F.lit("null_key")),
               F.when(F.col("key").isNotNull() & (F.col("n_fact") > 0) & (F.col("n_dim") == 0), F.lit("orphan")),
               F.when(F.col("n_dim") > 1, F.lit("duplicate_dimension"))]
    if one_to_one:
        reasons.append(F.when(F.col("key").isNotNull() & (F.col("n_fact") > 1), F.lit("duplicate_fact")))
    return both.withColumn("reason", F.explode(F.array_compact(F.array(*reasons)))).select("key", "reason", "n_fact", "n_dim")


def scored_customer_star(scored: DataFrame, dim: DataFrame, fact_key: str = "CUST_NUM", dim_key: str = ID,
                         attrs: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """J11 for scored facts (one-to-one): the facts whose key keeps to the relationship, with the
    customer's attributes, and the keys that don't (see ``relationship_check``)."""
    broken = relationship_check(scored, dim, fact_key, dim_key)
    bad = broken.where("key is not null").select(F.col("key").alias("_bad")).distinct()
    sound = scored.where(F.col(fact_key).isNotNull()).join(bad, F.col(fact_key) == F.col("_bad"), "left_anti")
    return fact_customer_star(sound, dim, fact_key, dim_key, attrs), broken


def date_dim_join(dim: DataFrame, dates: DataFrame, date_col: str = "birth_date") -> DataFrame:
    """Customer attributes with the calendar attributes of a date column
    (date part only)."""
    cal = dates.withColumnRenamed("Date", "_date")
    return dim.join(cal, F.to_date(dim[date_col]) == cal["_date"], "left").drop("_date")
