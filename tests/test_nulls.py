"""Null groups, null values and odd staged ids against plain windows and by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from propensia.functions import ranking
from propensia.operators import assemble, customers, labels, model, profile


def test_ranks_with_nulls_equal_windows(spark):
    rows = [(g, v, i) for i, (g, v) in enumerate([(None, 1.0), (None, None), (None, 1.0), ("a", None), ("a", 2.0), ("a", 1.0), ("b", 3.0)])]
    df = spark.createDataFrame(rows, "g string, v double, i int")
    up, down = Window.partitionBy("g").orderBy("v"), Window.partitionBy("g").orderBy(F.desc("v"))
    want = {r.i: (r.p, r.r) for r in df.select("i", F.percent_rank().over(up).alias("p"), F.rank().over(down).alias("r")).collect()}
    got = ranking.with_competition_rank(ranking.with_percent_rank(df, ["g"], "v", "p"), ["g"], "v", out_col="r").collect()
    assert {r.i: (r.p, r.r) for r in got} == want
    numbered = ranking.with_row_number(df, ["g"], [("v", True), ("i", True)], "n").collect()
    by = Window.partitionBy("g").orderBy("v", "i")
    assert {r.i: r.n for r in numbered} == {r.i: r.n for r in df.select("i", F.row_number().over(by).alias("n")).collect()}


@pytest.mark.parametrize("kind", ["int", "double", "date", "string"])
def test_ranks_of_null_groups_of_any_type(spark, kind):
    value = {"int": "g", "double": "g / 4d", "date": "date_add(date '2024-01-01', cast(g as int))", "string": "cast(g as string)"}[kind]
    df = spark.range(600).selectExpr("case when id % 3 = 0 then null else id % 5 end as g", "cast(id * 37 % 101 as double) as v", "id as i").selectExpr(f"{value} as g", "v", "i")
    up, down, by = (Window.partitionBy("g").orderBy(*o) for o in (["v"], [F.desc("v")], ["v", "i"]))
    want = df.select("i", F.percent_rank().over(up).alias("p"), F.rank().over(down).alias("r"), F.row_number().over(by).alias("n"))
    for parts in (1, 7):
        got = ranking.with_percent_rank(df, ["g"], "v", "p", num_partitions=parts)
        got = ranking.with_competition_rank(got, ["g"], "v", out_col="r", num_partitions=parts)
        got = ranking.with_row_number(got, ["g"], [("v", True), ("i", True)], "n", num_partitions=parts)
        assert "Python" not in got._jdf.queryExecution().executedPlan().toString() and "Pandas" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(got.select("i", "p", "r", "n").collect()) == sorted(want.collect())


def test_propensity_keeps_null_groups(spark):
    rows = [(i, 2020, None if i % 3 == 0 else 1, float(i)) for i in range(9)]
    out = labels.propensity_label(spark.createDataFrame(rows, "CUST_NUM long, YEAR int, MONTH int, a double"), {"a": 1.0}, 0.9).collect()
    assert sorted(r.CUST_NUM for r in out) == list(range(9))
    assert {r.CUST_NUM for r in out if r.TARGET} == {6, 8}   # the highest of each group, the null one too


def test_not_in_knows_nulls_and_empty_lists(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "cust_num long, name string")
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "cust_num long")
    names = lambda df: sorted(r.name for r in df.collect())
    assert names(customers.not_in(rows, ids())) == ["a", "b", "n"]
    assert names(customers.not_in(rows, ids(2, 2))) == ["a"]
    assert names(customers.not_in(rows, ids(7, None))) == []
    assert names(customers.not_in(rows.limit(0), ids(7))) == []


def test_relationship_violations(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,), (None,)], "CUST_NUM long")
    dim = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (9, "w"), (None, "v")], "cust_num long, name string")
    found = lambda **k: sorted((r.key or 0, r.reason, r.n_fact, r.n_dim) for r in customers.relationship_check(fact, dim, **k).collect())
    many = [(0, "null_key", 2, 0), (2, "duplicate_dimension", 1, 2), (3, "orphan", 1, 0)]
    assert found(one_to_one=False) == many and found() == sorted([*many, (1, "duplicate_fact", 2, 1)])
    star, broken = customers.scored_customer_star(fact, dim)
    assert star.count() == 0 and broken.count() == 4
    assert [tuple(r) for r in customers.scored_customer_star(fact.where("CUST_NUM = 1").distinct(), dim.where("cust_num = 1"))[0].collect()] == [(1, "x")]


def test_staged_nulls_and_duplicates(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "t")], "cust_num long, name string")
    staged = spark.createDataFrame([(2, "y"), (2, "x"), (None, "N"), (3, "z")], "cust_num long, name string")
    assert sorted(map(str, customers.customers_upsert(target, staged).collect())) == sorted(
        f"Row(cust_num={k}, name={v!r})" for k, v in [(1, "a"), (2, "x"), (None, "t"), (3, "z")])
    assert customers.customers_update(target, staged).count() == 3
    assert [tuple(r) for r in customers.customers_new_only(target, staged).collect()] == [(3, "z")]
    assert customers.customers_new_only(target, staged, null_aware=True).count() == 0


def test_request_join_has_one_plan(spark):
    df = spark.createDataFrame([(1, 1, 2020, 5.0), (2, 1, 2020, 6.0)], ["CUST_NUM", "MONTH", "YEAR", "x"])
    keys = assemble.JOIN_KEYS
    shapes = []
    for n in (1, 50):
        requests = df.where("CUST_NUM = 1").select(*keys).withColumn("EVENT_TYPE", F.lit("E")).withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("_")
        out = assemble.requests_left_join(df, requests, chunk=7)
        assert out.count() == n + 1
        shapes.append([line.split("#")[0].strip(" +-:") for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines()])
    assert [x.split(" ")[0] for x in shapes[0]] == [x.split(" ")[0] for x in shapes[1]]


def test_correlations_refuse_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    with pytest.raises(ValueError, match="nulls of a"):
        profile.correlation_pairs(df)


def test_summary_of_nulls_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    got = {r["column"]: r for r in profile.summary_stats(df).collect()}
    assert (got["a"]["count"], got["a"]["mean"], got["a"]["p50"]) == (2, 2.0, 2.0)
    assert (got["b"]["count"], got["b"]["mean"], got["b"]["p50"]) == (0, None, None)


def test_propensity_rows_are_not_shuffled_by_month(spark):
    rows = [(i, 2020, 1 + i % 2, float(i), float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "CUST_NUM long, YEAR int, MONTH int, a double, b double")
    out = labels.propensity_label(df, {"a": 0.5, "b": -0.1}, 0.97)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(YEAR" not in plan
    p = df.toPandas()
    by = p.groupby("MONTH")
    z = sum(w * (p[c] - by[c].transform("mean")) / by[c].transform(lambda s: s.std(ddof=0)) for c, w in (("a", 0.5), ("b", -0.1)))
    lo, hi = z.groupby(p.MONTH).transform("min"), z.groupby(p.MONTH).transform("max")
    s = (z - lo) / (hi - lo)
    want = dict(zip(p.CUST_NUM, (s >= s.groupby(p.MONTH).transform(lambda v: v.quantile(0.97))).astype(int)))
    assert {r.CUST_NUM: r.TARGET for r in out.collect()} == want


def test_versions_are_never_overwritten(spark, tmp_path):
    df = spark.createDataFrame([(float(i), i % 2) for i in range(20)], "a double, y int")
    fitted = model.train_gbt(df, ["a"], "y", maxIter=1)
    assert [model.register_model(spark, fitted, str(tmp_path), "m") for _ in range(2)] == [1, 2]
    assert model.load_latest(spark, str(tmp_path), "m").stages
