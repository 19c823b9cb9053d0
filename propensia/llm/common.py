"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, share_code

#: ASCII white space [\x20\x09-\x0D]; words are the runs between it.
SPACE_CLASS = r"[\x20\x09-\x0D]+"

#: Lets Spark delete a query's shuffle files at its end, not at some later garbage collection.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Rows, and bytes of their strings, that one Python step handles at a time (one row at least).
SLICE_ROWS, SLICE_BYTES = 512, 4 << 20

_scopes: list[dict[str, SparkSession]] = []   # the folders staged in each open scope


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    share_code(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate as Parquet in the shared checkpoint folder and read
    it back. It cuts the lineage (a lost executor re-reads files), keeps
    columns prunable, and gives the optimizer a measured size. Nothing reads the
    shuffles of the write again, so Spark removes their files when it ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    if _scopes:
        _scopes[-1][path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def unstage(spark: SparkSession, path: str) -> None:
    """Remove a staged folder that nothing reads again."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def let_go(*frames: DataFrame) -> None:
    """Remove what stage wrote for these frames: nothing reads them again."""
    for df in frames:
        unstage(df.sparkSession, df.staged_at)


@contextmanager
def scratch() -> Iterator[set[str]]:
    """Folders staged inside are removed at the end, but for those whose paths
    (``staged_at``) are added to the yielded set: the ones that the result still reads."""
    _scopes.append({})
    keep: set[str] = set()
    try:
        yield keep
    finally:
        own = _scopes.pop()
        for path, spark in own.items():
            if path not in keep:
                unstage(spark, path)
            elif _scopes:
                _scopes[-1][path] = spark


def numbered(df: DataFrame) -> DataFrame:
    """df with its columns called c0, c1, ..., so that none clashes with an operator's own."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def with_row_ids(df: DataFrame, name: str) -> DataFrame:
    """The rows with a unique ``_uid``, staged once so that the ids never change."""
    return stage(df.withColumn("_uid", F.monotonically_increasing_id()), name)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of few rows and bytes, which bounds a step's memory."""
    for batch in batches:
        sizes = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            fits = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right"))
            to = max(at + 1, min(at + rows, fits))
            yield batch.slice(at, to - at)
            at = to
