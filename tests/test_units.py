"""Hand-computed edge cases and invariants (§5.3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from propensia.functions.calendar import SourceMonths, shift_months
from propensia.operators import assemble as asm
from propensia.operators import customers as cu
from propensia.operators import evaluate as ev
from propensia.operators import features as fx
from propensia.operators import labels as lb
from propensia.operators import profile as pr


def test_shift_month_wraps_year(spark):
    df = spark.createDataFrame([(1, 2024, 1), (2, 2024, 7)], "CUST_NUM long, YEAR int, MONTH int")
    out = {r.CUST_NUM: (r.YEAR, r.MONTH) for r in shift_months(df, -1).collect()}
    assert out == {1: (2023, 12), 2: (2024, 6)}


def test_windows_from_source_months():
    m = SourceMonths((2023 * 12 + 10, 2023 * 12 + 11, 2024 * 12 + 0, 2024 * 12 + 1))  # Nov .. Feb
    w = fx.l3m_window(m, "train")
    assert (w.first, w.last) == (2023 * 12 + 9, 2023 * 12 + 11)   # Oct..Dec, anchor Feb
    assert fx.l3m_window(m, "score").last == 2024 * 12 + 0


def test_day_mask_counts_distinct_days(spark):
    rows = [(1, dt.datetime(2024, 1, d), "A", 10) for d in (1, 1, 2, 31)]
    df = spark.createDataFrame(rows, "CUST_NUM long, EVT_DT timestamp, WEBSITE_TYPE string, DURATION long")
    win = fx.MonthWindow(2024 * 12, 2024 * 12)
    out = fx.usage_monthly(fx.standardize_events(win.apply(df), "D"), "WEBSITE_TYPE", "D").collect()[0]
    assert out.NB_DAYS_USAGE_L3M == 3 and out.DURATION_L3M == 40


def test_full_join_coalesces_null_keys(spark):
    tv = spark.createDataFrame([(1, 2024, 1, 5)], "CUST_NUM long, YEAR int, MONTH int, T long")
    it = spark.createDataFrame([(2, 2024, 1, 7)], "CUST_NUM long, YEAR int, MONTH int, I long")
    out = asm.usage_full_join(tv, it).collect()
    assert sorted(r.CUST_NUM for r in out) == [1, 2]      # no null customer ids
    assert len(out) >= 2


def test_requests_fan_out_and_label_no_fan_out(spark):
    base = spark.createDataFrame([(1, 2024, 1)], "CUST_NUM long, YEAR int, MONTH int")
    req = spark.createDataFrame([(1, 2024, 1, "CHURN REQUEST"), (1, 2024, 1, "SPORT REQUEST"),
                                 (1, 2024, 2, "CHURN REQUEST"), (1, 2024, 2, "CHURN REQUEST")],
                                "CUST_NUM long, YEAR int, MONTH int, EVENT_TYPE string")
    assert asm.requests_left_join(base, req).count() == 2          # J3 duplicates the row
    lab = lb.label_next_month(base, req, "CHURN REQUEST", "TARGET_CHURN").collect()
    assert len(lab) == 1 and lab[0].TARGET_CHURN == 1              # M1 does not


def test_tile_sizes_when_n_not_multiple_of_20(spark):
    n = 42
    df = spark.createDataFrame([(i, "M", 1.0 - i / 100.0) for i in range(n)], "ROW_ID long, MODEL_TYPE string, y_proba double")
    sizes = [r[1] for r in sorted(ev.score_tiles(df).groupBy("TILE").count().collect())]
    assert sizes[0] == 3 and sizes[-1] == 3 and sum(sizes) == n and len(sizes) == 20
    rep = ev.report_tiles(df).groupBy("Decile").count().collect()
    rep_sizes = {r[0]: r[1] for r in rep}
    assert rep_sizes[1] == 3 and rep_sizes[11] == 3 and sum(rep_sizes.values()) == n


def test_lift_invariants(spark):
    rows = [(i, "M", i % 7 == 0 and 1 or 0, ((i * 37) % 101) / 101.0) for i in range(300)]
    df = spark.createDataFrame(rows, "ROW_ID long, MODEL_TYPE string, TARGET int, y_proba double")
    lift = ev.lift_table(ev.score_tiles(df)).collect()
    assert lift[-1].running_recall == 1.0 and lift[-1].running_total == 300
    tot = [r.running_total for r in lift]
    assert tot == sorted(tot)


def test_zero_denominators(spark):
    cm = spark.createDataFrame([("M", 0, 0, 0, 5)], "MODEL_TYPE string, TP long, FP long, FN long, TN long")
    sc = ev.model_scorecard(cm).collect()[0]
    assert sc.Recall is None and sc.Precision is None and sc.F1 is None
    assert sc.Accuracy == 1.0 and sc.FPR == 0.0
    df = spark.createDataFrame([(1, "M", 0, 0.5), (2, "M", 0, 0.7)], "ROW_ID long, MODEL_TYPE string, TARGET int, y_proba double")
    assert ev.roc_auc(df).collect()[0].AUC is None                  # no positives


def test_confusion_counts_cover_n(spark):
    rows = [(i, "M", i % 3 == 0 and 1 or 0, i / 10.0) for i in range(10)]
    df = ev.apply_threshold(spark.createDataFrame(rows, "ROW_ID long, MODEL_TYPE string, TARGET int, y_proba double"), 0.5)
    r = ev.confusion_counts(df).collect()[0]
    assert r.TP + r.FP + r.FN + r.TN == 10


def test_auc_with_ties_matches_rank_formula(spark):
    rows = [(1, "M", 1, 0.9), (2, "M", 0, 0.9), (3, "M", 1, 0.5), (4, "M", 0, 0.1)]
    df = spark.createDataFrame(rows, "ROW_ID long, MODEL_TYPE string, TARGET int, y_proba double")
    # pairs (pos, neg): (0.9,0.9)=0.5, (0.9,0.1)=1, (0.5,0.9)=0, (0.5,0.1)=1 -> 2.5 / 4
    assert ev.roc_auc(df).collect()[0].AUC == 0.625


def test_upsert_unique_ids_and_null_overwrites(spark):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "cust_num long, first_name string, city string")
    s = spark.createDataFrame([(2, "b2", None), (3, "c", "z")], "cust_num long, first_name string, city string")
    out = {r.cust_num: (r.first_name, r.city) for r in cu.customers_upsert(t, s).collect()}
    assert out == {1: ("a", "x"), 2: ("b2", None), 3: ("c", "z")}
    assert [r.cust_num for r in cu.customers_new_only(t, s).collect()] == [3]
    t_null = t.union(spark.createDataFrame([(None, "n", "n")], t.schema))
    assert cu.customers_new_only(t_null, s, null_aware=True).count() == 0   # NOT IN semantics


def test_split_by_hash_disjoint_and_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "CUST_NUM")
    a = lb.split_by_hash(df).repartition(1).where("SPLIT = 'train'")
    b = lb.split_by_hash(df).repartition(7).where("SPLIT = 'train'")
    assert a.exceptAll(b).count() == 0
    assert lb.split_by_hash(df).where("SPLIT = 'test'").join(a, "CUST_NUM").count() == 0


def test_exact_quantiles_match_linear(spark):
    df = spark.createDataFrame([("c", float(v)) for v in [1, 2, 3, 4, 10]], "column string, value double")
    r = pr.exact_quantiles(df, ["column"], "value", [0.25, 0.5, 0.9]).collect()[0]
    assert (r.q0, r.q1) == (2.0, 3.0) and abs(r.q2 - 7.6) < 1e-12


def test_unpivot_requests_drops_recent(spark):
    wide = spark.createDataFrame([(1, dt.date(2024, 1, 1), 1, 0), (2, dt.date(2024, 3, 1), 1, 1)],
                                 "CUST_NUM long, date date, churn_target int, sport_target int")
    out = lb.unpivot_requests(wide, {"churn_target": "CHURN REQUEST", "sport_target": "SPORT REQUEST"}).collect()
    assert [(r.CUST_NUM, r.EVENT_TYPE) for r in out] == [(1, "CHURN REQUEST")]


def test_union_merge_assembly_equals_join_chain(spark):
    from propensia.plans.featureset import build_feature_tables, fixture_sources
    from tests.conftest import SF001
    t = build_feature_tables(fixture_sources(spark, SF001), "train")
    for req in (None, t.requests):
        a = asm.assemble(t.tv, t.internet, t.mobile, t.socio, t.journeys, req)
        b = asm.assemble_by_joins(t.tv, t.internet, t.mobile, t.socio, t.journeys, req)
        assert a.columns == b.columns
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_requests_fan_out_hot_key_is_whole(spark):
    base = spark.createDataFrame([(1, 2024, 1), (2, 2024, 1), (3, 2024, 2)], "CUST_NUM long, YEAR int, MONTH int")
    rows = [(1, 2024, 1, "CHURN REQUEST")] * 103 + [(1, 2024, 1, "SPORT REQUEST")] * 5 \
        + [(2, 2024, 1, "CHURN REQUEST")] * 2
    req = spark.createDataFrame(rows, "CUST_NUM long, YEAR int, MONTH int, EVENT_TYPE string")
    out = asm.requests_left_join(base, req, chunk=7)
    naive = base.join(req, ["CUST_NUM", "YEAR", "MONTH"], "left")
    assert out.count() == 103 + 5 + 2 + 1
    assert out.exceptAll(naive.select(*out.columns)).count() == 0
    assert naive.select(*out.columns).exceptAll(out).count() == 0


def test_correlation_pairs_match_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    a = rng.normal(size=400)
    b = 0.6 * a + rng.normal(size=400)
    d = -a + 0.1 * rng.normal(size=400)
    rows = [(float(x), float(y), 5.0, float(z)) for x, y, z in zip(a, b, d)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    got = {(r.col1, r.col2): r.corr for r in pr.correlation_pairs(df, digits=4).collect()}
    m = np.corrcoef(np.vstack([a, b, d]))
    want = {("a", "b"): m[0, 1], ("a", "d"): m[0, 2], ("b", "d"): m[1, 2]}
    assert len(got) == 6
    for k, v in want.items():
        assert abs(got[k] - round(v, 4)) < 1e-9
    assert got[("a", "c")] is None and got[("b", "c")] is None and got[("c", "d")] is None


def test_shared_usage_pass_equals_single_source(spark):
    from propensia.functions.calendar import sources_months
    from propensia.plans.featureset import fixture_sources
    from tests.conftest import SF001
    src = fixture_sources(spark, SF001)
    cal = sources_months({n: src[n] for n in ("internet", "tv")})
    parts = [(src["internet"], fx.INTERNET, fx.l3m_window(cal["internet"], "train")),
             (src["tv"], fx.TV, fx.l3m_window(cal["tv"], "train"))]
    shared = fx.usage_features_many(parts)
    for (raw, spec, win), got in zip(parts, shared):
        alone = fx.usage_features(raw, spec, win)
        assert got.columns == alone.columns and got.count() == alone.count() > 0
        assert got.exceptAll(alone).count() == 0 and alone.exceptAll(got).count() == 0


def test_filter_mobile_subscribers(spark):
    from propensia.plans.catalog import load_all
    from .conftest import SF001
    rows = load_all()["filter_mobile_subscribers"].build(spark, SF001).select("NB_MOBILE_SUBS").distinct().collect()
    assert {r[0] for r in rows} == {1, 2, 3}
