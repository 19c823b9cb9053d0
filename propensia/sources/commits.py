"""Numbered commits in a shared folder, and tables that are replaced by one of them.

A commit is one small JSON file whose name is its number. A writer creates the file
of the next number only if it does not exist; whoever comes second takes the number
after it. What a commit names is written before it, under a name that no one else
uses, so a crash leaves no trace that a reader could see.

Files go through Hadoop's file system of the folder, so a commit on an object store is
as exclusive as the store's create-if-absent; on a local file system it is a hard link.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

_DIGITS = 12


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file with its whole content, unless it exists."""
    where, fs = _fs(spark, path)
    data = bytearray(text.encode())
    if fs.getScheme() == "file":
        files, paths = spark._jvm.java.nio.file.Files, spark._jvm.java.nio.file.Paths
        target = paths.get(fs.makeQualified(where).toUri())
        files.createDirectories(target.getParent(), spark.sparkContext._gateway.new_array(spark._jvm.java.nio.file.attribute.FileAttribute, 0))
        draft = target.resolveSibling(f".{uuid.uuid4().hex}")
        files.write(draft, data, spark.sparkContext._gateway.new_array(spark._jvm.java.nio.file.OpenOption, 0))
        try:
            files.createLink(target, draft)
        except Exception as error:
            if "FileAlreadyExistsException" not in str(error):
                raise
            return False
        finally:
            files.deleteIfExists(draft)
        return True
    try:
        out = fs.create(where, False)
    except Exception as error:
        if "AlreadyExists" not in str(error) and "already exists" not in str(error):
            raise
        return False
    try:
        out.write(data)
    finally:
        out.close()
    return True


def delete(spark: SparkSession, path: str) -> None:
    where, fs = _fs(spark, path)
    fs.delete(where, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """What the folder holds; nothing if it isn't there."""
    where, fs = _fs(spark, folder)
    return sorted(status.getPath().getName() for status in fs.listStatus(where)) if fs.exists(where) else []


def commits(spark: SparkSession, folder: str) -> dict[int, dict]:
    """number -> content of every commit; a file that is not written to its end is none yet."""
    where, fs = _fs(spark, folder)
    if not fs.exists(where):
        return {}
    found = {}
    for status in fs.listStatus(where):
        name = status.getPath().getName()
        if not name[:_DIGITS].isdigit() or not name.endswith(".json"):
            continue
        stream = fs.open(status.getPath())
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        if text.endswith("\n"):
            found[int(name[:_DIGITS])] = json.loads(text)
    return found


def commit(spark: SparkSession, folder: str, content: dict) -> int:
    """Add the content as the next number, however many writers there are; the number."""
    where, fs = _fs(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    number = 1 + max((int(n[:_DIGITS]) for n in names if n[:_DIGITS].isdigit()), default=0)
    while not _create_new(spark, f"{folder.rstrip('/')}/{number:0{_DIGITS}d}.json", json.dumps(content) + "\n"):
        number += 1
    return number


# ---------------------------------------------------------------------------- S4


def _data(spark: SparkSession, root: str) -> list[str]:
    where, fs = _fs(spark, f"{root.rstrip('/')}/data")
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def stage_snapshot(df: DataFrame, root: str, partition_by: list[str] | None = None) -> str:
    """Write the next content of the table beside its present one; the name to publish."""
    name = uuid.uuid4().hex
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(f"{root.rstrip('/')}/data/{name}")
    return name


def publish_snapshot(spark: SparkSession, root: str, name: str, schema: str) -> int:
    """The staged content becomes the table: one commit, before which readers see the version before."""
    return commit(spark, f"{root.rstrip('/')}/_commits", {"data": name, "schema": schema})


def replace_table(df: DataFrame, root: str, partition_by: list[str] | None = None, keep: int = 2) -> DataFrame:
    """Replace the whole table at ``root`` by the frame (which may read that
    table) in one step, drop versions older than the last ``keep``, and return the table read back.

    Readers that began on an older version finish on it as long as it is kept."""
    spark = df.sparkSession
    publish_snapshot(spark, root, stage_snapshot(df, root, partition_by), df.schema.json())
    vacuum(spark, root, keep)
    return read_snapshot(spark, root)


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table at its last version (or a kept older one)."""
    from pyspark.sql.types import StructType

    known = commits(spark, f"{root.rstrip('/')}/_commits")
    number = max(known, default=0) if version is None else version
    if number not in known:
        raise LookupError(f"no version {number} of the table at {root}")
    return spark.read.schema(StructType.fromJson(json.loads(known[number]["schema"]))).parquet(f"{root.rstrip('/')}/data/{known[number]['data']}")


def vacuum(spark: SparkSession, root: str, keep: int = 2, orphans: bool = False) -> list[str]:
    """Remove the data and commits of versions older than the last ``keep`` (one at
    least). Data that no commit names belongs to a writer at work or to one that
    crashed; it goes only with ``orphans``, when no writer is at work. The names removed."""
    root = root.rstrip("/")
    known = commits(spark, f"{root}/_commits")
    old = sorted(known)[:-max(keep, 1)]
    named = {c["data"] for c in known.values()}
    gone = [known[n]["data"] for n in old] + [d for d in _data(spark, root) if orphans and d not in named]
    for number in old:
        delete(spark, f"{root}/_commits/{number:0{_DIGITS}d}.json")
    for name in gone:
        delete(spark, f"{root}/data/{name}")
    return gone
