"""Session construction and shared scratch storage.

Jobs never write to a machine-local temporary folder when a cluster names a
shared checkpoint folder: every scratch path hangs off ``spark.checkpoint.dir``.
A default is only installed when the setting is absent (local runs and tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes (so a
# small side becomes a broadcast only when it is measured small) and splits
# skewed shuffle partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of garbage-collected frames are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "propensia", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. Only a local master gets a default:
    a machine-local folder on a cluster would hide files from other executors."""
    sc = spark.sparkContext
    share_code(spark)
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        cur = os.path.join(tempfile.gettempdir(), f"propensia-ckpt-{uuid.uuid4().hex[:8]}")
        spark.conf.set("spark.checkpoint.dir", cur)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(cur)
    return cur


def share_code(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (a
    shared folder); clusters without one ship it with --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write an intermediate as Parquet in the shared checkpoint folder and read
    it back: later scans read only the columns they need, and Spark knows the
    written size when it plans the joins (a few rows of statistics are broadcast,
    a large table is shuffled)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for one job's output."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/work/{name}-{uuid.uuid4().hex[:10]}"
