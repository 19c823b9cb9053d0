"""Streaming ingest (T1): incremental runs and a hot group of copies."""

from __future__ import annotations

import datetime as dt

from propensia.session import scratch_path
from propensia.sources.commits import names
from propensia.streaming.daily_ingest import DAY_PARTS, EVENT_SCHEMA, counted_events, land_events, late_events, run_daily_ingest


def _drop(spark, rows, path):
    spark.createDataFrame(rows, EVENT_SCHEMA).write.mode("append").parquet(path)


def test_copies_counted_once_across_drops_and_runs(spark):
    land = scratch_path(spark, "t_landing")
    out, ckpt = scratch_path(spark, "t_out"), scratch_path(spark, "t_ckpt")
    d1, d2 = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 2, 9)
    hot = [(7, d1, 1, "click", 1.25, "{}")] * 3000          # one event, many copies
    _drop(spark, hot + [(8, d1, 2, "view", 2.5, "{}")], land)
    first = {(r.event_type, r.n_events, r.total_value_cents)
             for r in run_daily_ingest(spark, land, out, ckpt).collect()}
    assert first == {("click", 1, 125), ("view", 1, 250)}
    # the next drop repeats the hot event and adds a new day; the rerun resumes
    _drop(spark, hot[:500] + [(9, d2, 3, "click", 0.5, "{}")], land)
    second = {(r.window_start.day, r.event_type, r.n_events, r.total_value_cents)
              for r in run_daily_ingest(spark, land, out, ckpt).collect()}
    assert second == {(1, "click", 1, 125), (1, "view", 1, 250), (2, "click", 1, 50)}


def test_late_and_undated_events_are_counted(spark):
    land, out, ckpt = (scratch_path(spark, n) for n in ("t_late_landing", "t_late_out", "t_late_ckpt"))
    day = lambda n: dt.datetime(2024, 1, n, 12)
    for n in (1, 2, 9):
        _drop(spark, [(n, day(n), 1, "click", 1.0, "{}")], land)
        run_daily_ingest(spark, land, out, ckpt)
    # day 4 lands 5 days late, with a copy of a counted event and one without ts
    _drop(spark, [(4, day(4), 1, "click", 2.0, "{}"), (2, day(2), 1, "click", 1.0, "{}"), (50, None, 1, "view", 3.0, "{}")], land)
    got = {(r.window_start and r.window_start.day, r.event_type, r.n_events, r.total_value_cents) for r in run_daily_ingest(spark, land, out, ckpt).collect()}
    assert got == {(1, "click", 1, 100), (2, "click", 1, 100), (4, "click", 1, 200), (9, "click", 1, 100), (None, "view", 1, 300)}
    assert {(r.event_id, r.reason) for r in late_events(spark, out).collect()} == {(4, "late"), (50, "undated")}


def test_undated_events_are_landed(spark):
    path = scratch_path(spark, "t_undated")
    rows = [(1, dt.datetime(2024, 1, 1), 1, "a", 1.0, "{}"), (2, None, 1, "a", 1.0, "{}")]
    assert land_events(spark.createDataFrame(rows, EVENT_SCHEMA), path) == 2 and spark.read.parquet(path).count() == 2


def test_files_stay_bounded_over_many_batches(spark):
    """50 batches on three days, each with a copy of an earlier event and every tenth with an undated row: totals are
    exact, a day has few parts, and only the last two batches' index and totals remain."""
    land, out, ckpt = (scratch_path(spark, n) for n in ("t_many_landing", "t_many_out", "t_many_ckpt"))
    day = lambda n: dt.datetime(2024, 1, 1 + n % 3, 12, n % 60)
    for n in range(50):
        rows = [(n, day(n), 1, "click", 1.0, "{}")] + [(n - 3, day(n - 3), 1, "click", 1.0, "{}")] * (n >= 3) + [(900 + n, None, 1, "view", 2.0, "{}")] * (n % 10 == 0)
        spark.createDataFrame(rows, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(land)
    got = {(r.window_start and r.window_start.day, r.event_type, r.n_events) for r in run_daily_ingest(spark, land, out, ckpt, max_files_per_trigger=1).collect()}
    assert got == {(1, "click", 17), (2, "click", 17), (3, "click", 16), (None, "view", 5)}
    assert sorted(r.event_id for r in counted_events(spark, out).collect()) == sorted([*range(50), *range(900, 950, 10)])
    assert len(names(spark, f"{out}/index")) <= 2 and len(names(spark, f"{out}/totals")) <= 2
    parts = [f for folder in names(spark, f"{out}/events") for f in names(spark, f"{out}/events/{folder}") if f.startswith("day=")]
    assert len(parts) <= 2 * 4 * (DAY_PARTS + 1)   # three days and the undated rows, in two indexes
