"""Incremental ingest of daily landed event files with per-day totals.

Sources land one day per run; instead of re-reading the full history every
month, a file stream picks up only new files. Each trigger takes the events not
counted yet, however late, adds them to the event table, and adds their counts and
sums per day and type to the totals; late and undated events are listed in a side table too.

The event table is a set of parts, each with rows of one day (or of no day), that an
index names: the index of a batch is that of the batch before with the batch's own
parts added. A batch opens only the parts of the days near its own, by name, so
older days are neither listed nor read; a day with more than ``DAY_PARTS`` parts is
merged into one. Totals are one small table for each batch, made from the one before.
No batch changes what the index before it names, so a repeated batch replaces its own
files and finds what it found first. Once a batch is committed (the next one has
begun), what only older indexes name is removed. The checkpoint
lives under the shared ``spark.checkpoint.dir`` so a restarted driver or a
lost executor resumes from the last committed batch; ``availableNow``
processes everything landed so far, then stops, which is what a daily
scheduled run wants.
"""

from __future__ import annotations

import datetime as _dt
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sources.commits import delete, names

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


EVENTS = "event_id bigint, ts timestamp_ntz, event_type string, value double"
TOTALS = "window_start timestamp_ntz, event_type string, n_events bigint, total_value_cents bigint, last_ts timestamp_ntz"
INDEX = "day string, path string"
LATE = "event_id bigint, ts timestamp_ntz, event_type string, value double, reason string, batch bigint"
UNDATED = "undated"
#: Parts that a day may have before they are merged.
DAY_PARTS = 8


def daily_totals(events: DataFrame) -> DataFrame:
    """Per (day, event type): event count and value sum in integer cents
    (exact under any arrival order) and last ts. Days are cut on the wall-clock ``ts``,
    so they don't depend on the session time zone; undated events have a null day."""
    return events.groupBy(F.to_date("ts").cast("timestamp_ntz").alias("window_start"), "event_type").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum(F.round(F.col("value") * 100).cast("long")).alias("total_value_cents"),
        F.max("ts").alias("last_ts"))


def days_near(batch: DataFrame, watermark: str) -> set[str]:
    """The days within the watermark of the batch's days, and that of undated rows; bounded by the calendar."""
    near = F.explode(F.sequence(F.to_date(F.expr(f"ts - interval {watermark}")), F.to_date(F.expr(f"ts + interval {watermark}"))))
    return {str(r[0]) for r in batch.where("ts is not null").select(near).distinct().collect()} | {UNDATED}


def new_events(batch: DataFrame, counted: DataFrame | None) -> DataFrame:
    """One row per event_id of the batch (the earliest; undated ones last) that isn't
    among the counted events. Copies combine before the shuffle."""
    row = F.min(F.struct(F.col("ts").isNull().alias("undated"), "ts", "event_type", "value")).alias("_row")
    once = batch.groupBy("event_id").agg(row).select("event_id", "_row.ts", "_row.event_type", "_row.value")
    if counted is None:
        return once
    known = counted.select(F.col("event_id").alias("_known"))
    return once.join(known, F.col("event_id").eqNullSafe(F.col("_known")), "left_anti")


def _last_index(spark: SparkSession, out_path: str, below: int | None = None) -> int | None:
    """The number of the newest whole index, of batches below a number if one is given."""
    found = [int(n.split("=")[1]) for n in names(spark, f"{out_path}/index") if n.startswith("batch=")]
    found = [n for n in found if below is None or n < below]
    return max((n for n in found if "_SUCCESS" in names(spark, f"{out_path}/index/batch={n}")), default=None)


def _parts(spark: SparkSession, out_path: str, batch: int | None) -> list[tuple[str, str]]:
    """(day, path) of the parts that a batch's index names: for each day at most DAY_PARTS."""
    return [] if batch is None else [tuple(r) for r in spark.read.schema(INDEX).parquet(f"{out_path}/index/batch={batch}").collect()]


def _write_parts(rows: DataFrame, out_path: str, folder: str) -> list[tuple[str, str]]:
    """Write rows by day; no task gets a hot day alone, and few tasks have a share of a day."""
    day = F.coalesce(F.to_date("ts").cast("string"), F.lit(UNDATED))
    (rows.withColumn("day", day).repartitionByRange("day", "event_id")
     .write.mode("overwrite").partitionBy("day").parquet(f"{out_path}/{folder}"))
    return [(n.split("=", 1)[1], f"{folder}/{n}") for n in names(rows.sparkSession, f"{out_path}/{folder}") if n.startswith("day=")]


def _read_parts(spark: SparkSession, out_path: str, paths: list[str]) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(*[f"{out_path}/{p}" for p in paths]) if paths else spark.createDataFrame([], EVENTS)


def _remove_replaced(spark: SparkSession, out_path: str, committed: int) -> None:
    """Remove what only indexes before a committed one name, the indexes last."""
    live = {path for _, path in _parts(spark, out_path, committed)}
    folders = {path.split("/day=")[0] for path in live}
    for n in sorted(int(name.split("=")[1]) for name in names(spark, f"{out_path}/index") if name.startswith("batch=")):
        if n >= committed:
            break
        old = {path for _, path in _parts(spark, out_path, n)}
        gone = ({path.split("/day=")[0] for path in old} | {f"events/batch={n}", f"events/merged={n}"}) - folders
        for path in sorted(gone | {path for path in old - live if path.split("/day=")[0] not in gone}) + [f"totals/batch={n}", f"index/batch={n}"]:
            delete(spark, f"{out_path}/{path}")


def land_events(events: DataFrame, landing_dir: str, days_per_drop: int = 4) -> int:
    """Land events as the upstream systems do: one drop of files per block of
    ``days_per_drop`` days, written in time order (so file times follow
    event times), then one of the rows without ts, if any. Returns the number of drops. The number of drops is the
    calendar span over the block size, not a function of the row count."""
    bounds = events.agg(F.min(F.to_date("ts")).alias("lo"), F.max(F.to_date("ts")).alias("hi"),
                        F.count_if(F.col("ts").isNull()).alias("undated")).first()
    lo, hi = bounds["lo"], bounds["hi"]
    drops = 0
    day = lo
    while lo is not None and day <= hi:
        end = day + _dt.timedelta(days=days_per_drop)
        (events.where((F.col("ts") >= F.lit(_dt.datetime.combine(day, _dt.time())))
                      & (F.col("ts") < F.lit(_dt.datetime.combine(end, _dt.time()))))
               .write.mode("append").parquet(landing_dir))
        drops += 1
        day = end
    if bounds["undated"]:
        events.where(F.col("ts").isNull()).write.mode("append").parquet(landing_dir)
        drops += 1
    return drops


def run_daily_ingest(spark: SparkSession, source_path: str, out_path: str | None = None,
                     checkpoint: str | None = None, schema: T.StructType = EVENT_SCHEMA,
                     watermark: str = "2 days", max_files_per_trigger: int | None = None) -> DataFrame:
    """Process every landed file not yet seen and return the totals of all batches.
    out_path (folders events, index, totals and late) and checkpoint belong together."""
    out_path = out_path or scratch_path(spark, "daily_totals")
    checkpoint = checkpoint or scratch_path(spark, "daily_totals_ckpt")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(source_path).select("event_id", "ts", "event_type", "value")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        before = _last_index(session, out_path, below=batch_id)
        if before is not None:
            _remove_replaced(session, out_path, before)
        parts = _parts(session, out_path, before)
        near = days_near(batch, watermark)
        counted = [path for day, path in parts if day in near]
        totals = None if before is None else session.read.schema(TOTALS).parquet(f"{out_path}/totals/batch={before}")
        last = None if totals is None else totals.agg(F.max("last_ts")).first()[0]

        own = _write_parts(new_events(batch, _read_parts(session, out_path, counted) if counted else None), out_path, f"events/batch={batch_id}")
        found = _read_parts(session, out_path, [path for _, path in own])
        late = F.when(F.col("ts").isNull(), F.lit("undated"))
        if last is not None:
            late = late.when(F.col("ts") < F.lit(str(last)).cast("timestamp_ntz") - F.expr(f"interval {watermark}"), F.lit("late"))
        late_rows = found.select("event_id", "ts", "event_type", "value", late.alias("reason")).where("reason is not null")
        if not late_rows.isEmpty():
            late_rows.write.mode("overwrite").parquet(f"{out_path}/late/batch={batch_id}")
        sums = daily_totals(found) if totals is None else daily_totals(found).unionByName(totals)
        sums.groupBy("window_start", "event_type").agg(
            F.sum("n_events").alias("n_events"), F.sum("total_value_cents").alias("total_value_cents"), F.max("last_ts").alias("last_ts")
        ).coalesce(1).write.mode("overwrite").parquet(f"{out_path}/totals/batch={batch_id}")   # days x types

        parts += own
        many = [day for day, n in Counter(day for day, _ in parts).items() if n > DAY_PARTS]
        if many:
            merged = _write_parts(_read_parts(session, out_path, [path for day, path in parts if day in many]), out_path, f"events/merged={batch_id}")
            parts = [p for p in parts if p[0] not in many] + merged
        session.createDataFrame(parts, INDEX).coalesce(1).write.mode("overwrite").parquet(f"{out_path}/index/batch={batch_id}")

    q = (stream.writeStream
         .option("checkpointLocation", checkpoint)
         .foreachBatch(write_batch)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    done = _last_index(spark, out_path)
    totals = spark.createDataFrame([], TOTALS) if done is None else spark.read.schema(TOTALS).parquet(f"{out_path}/totals/batch={done}")
    return totals.select("window_start", F.expr("window_start + interval 1 day").alias("window_end"), "event_type", "n_events", "total_value_cents")


def counted_events(spark: SparkSession, out_path: str) -> DataFrame:
    """The event table: every counted event once. What it reads is kept until the batch after the next one begins."""
    return _read_parts(spark, out_path, [path for _, path in _parts(spark, out_path, _last_index(spark, out_path))])


def late_events(spark: SparkSession, out_path: str) -> DataFrame:
    """The counted events that came later than the watermark or without ts, with the reason and their batch."""
    if not names(spark, f"{out_path}/late"):
        return spark.createDataFrame([], LATE)
    return spark.read.schema(LATE).parquet(f"{out_path}/late")
