"""Streaming ingest query (T1) with its batch-equivalent oracle."""

from __future__ import annotations

from ..session import scratch_path
from ..streaming.daily_ingest import land_events, run_daily_ingest
from .catalog import register


@register("daily_ingest_stream", "T1", """
select time_bucket(interval 1 day, ts) as window_start,
       time_bucket(interval 1 day, ts) + interval 1 day as window_end,
       event_type, count(*) as n_events,
       cast(sum(cast(round(value * 100) as bigint)) as bigint) as total_value_cents
from (select distinct on (event_id) * from events)
group by 1, 2, 3""")
def q_daily_ingest_stream(spark, sf_dir):
    """Land the events as time-ordered drops, then ingest them a few files per
    micro-batch so the watermark and the state advance across batches."""
    landing = scratch_path(spark, "landing_events")
    land_events(spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet"), landing, days_per_drop=4)
    return run_daily_ingest(spark, landing, max_files_per_trigger=8)
