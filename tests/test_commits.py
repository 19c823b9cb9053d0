"""Replacing a table, registering models: concurrent writers, readers meanwhile, crashes."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from propensia.operators import model
from propensia.sources import commits


def test_a_reader_during_a_replace_sees_a_whole_table(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    first = commits.replace_table(spark.range(1000).withColumn("v", F.lit(1)), root)
    reader = commits.read_snapshot(spark, root)   # planned on version 1
    name = commits.stage_snapshot(first.withColumn("v", F.lit(2)).union(first), root)
    assert commits.read_snapshot(spark, root).agg(F.sum("v")).first()[0] == 1000   # staged, not yet published
    commits.publish_snapshot(spark, root, name, first.schema.json())
    commits.vacuum(spark, root)
    assert reader.agg(F.count("v"), F.max("v")).first()[:] == (1000, 1)   # its version is kept
    assert commits.read_snapshot(spark, root).agg(F.count("v"), F.max("v")).first()[:] == (2000, 2)
    third = commits.replace_table(commits.read_snapshot(spark, root).where("v = 2"), root)   # reads what it replaces
    assert third.count() == 1000 and sorted(commits.commits(spark, f"{root}/_commits")) == [2, 3]
    with pytest.raises(LookupError):
        commits.read_snapshot(spark, root, 1)
    assert commits.read_snapshot(spark, root, 2).count() == 2000


def test_a_crash_before_the_commit_changes_nothing(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    commits.replace_table(spark.range(10), root)
    bad = spark.range(10).withColumn("id", F.expr("if(id = 7, raise_error('crash'), id)").cast("long"))
    with pytest.raises(Exception, match="crash"):
        commits.replace_table(bad, root)
    lost = commits.stage_snapshot(spark.range(3), root)   # a writer that dies here
    assert commits.read_snapshot(spark, root).count() == 10
    assert commits.vacuum(spark, root) == [] and lost in commits.vacuum(spark, root, orphans=True)
    assert commits.read_snapshot(spark, root).count() == 10


def test_an_unfinished_commit_file_is_none(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    commits.replace_table(spark.range(4), root)
    (tmp_path / "t" / "_commits" / "000000000002.json").write_text('{"data": "ab')
    assert commits.read_snapshot(spark, root).count() == 4
    assert commits.replace_table(spark.range(5), root).count() == 5 and max(commits.commits(spark, f"{root}/_commits")) == 3


def test_concurrent_commits_get_numbers_of_their_own(spark, tmp_path):
    folder = f"file://{tmp_path}/log"
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda i: commits.commit(spark, folder, {"i": i}), range(40)))
    found = commits.commits(spark, folder)
    assert sorted(numbers) == list(range(1, 41)) == sorted(found) and all(found[n] == {"i": i} for i, n in enumerate(numbers))


def test_two_writers_register_two_versions(spark, tmp_path):
    df = spark.createDataFrame([(float(i), i % 2) for i in range(20)], "a double, y int")
    fitted = [model.train_gbt(df, ["a"], "y", maxIter=n) for n in (1, 2)]
    root = f"file://{tmp_path}/models"
    with ThreadPoolExecutor(2) as pool:
        versions = list(pool.map(lambda m: model.register_model(spark, m, root, "m"), fitted))
    assert sorted(versions) == [1, 2]
    newest = fitted[versions.index(2)]
    assert model.load_latest(spark, root, "m").stages[-1].getNumTrees == newest.stages[-1].getNumTrees
    last = model.latest_versions(model.registry(spark, root, "m")).first()
    assert (last["version"], last["alias"]) == (2, "last")
    with pytest.raises(LookupError):
        model.load_latest(spark, root, "other")
