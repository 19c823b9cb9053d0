"""Exact duplicates by distributed MSD radix partitioning.

Texts are compared after removal of ASCII white space. A group of texts that
agree so far is split by its next bytes: a digit of 64 bytes, then digits
sixteen times longer each round. Counting a digit is a map-side combined
aggregate, so a group that holds a third of all rows sends one row per map task,
and rows find their new group by an equi-join that Spark splits when skewed. A
group of one text, or one whose texts have ended, is done. Equality is the
equality of bytes; no digest decides anything.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, numbered, scratch, stage, with_row_ids

FIRST_DIGIT = 64
GROWTH = 16


def normalised(text: str = "text"):
    """The text without ASCII white space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE_CLASS, "")


def duplicate_groups(rows: DataFrame, first_digit: int = FIRST_DIGIT) -> DataFrame:
    """rows: _uid (unique), _id, _cp (code points of the original text), _norm
    (binary). Returns _uid, keep_uid, keep_id, group_size for every row of a
    group of two or more. Of a group the row with most code points stays, then
    the smallest id (null ids last), then the smallest _uid."""
    cur = rows.select("_uid", "_id", "_cp", F.lit(0).cast("long").alias("_gid"), F.col("_norm").alias("_rest"))
    size, done = first_digit, []
    while True:
        cur = cur.withColumns({"_digit": F.substring("_rest", 1, size), "_ended": F.length("_rest") <= size})
        best = F.min(F.struct((-F.col("_cp")).alias("c"), F.col("_id").isNull().alias("z"), F.col("_id").alias("i"), F.col("_uid").alias("u")))
        groups = cur.groupBy("_gid", "_digit", "_ended").agg(
            F.min("_uid").alias("_new"), F.count(F.lit(1)).alias("group_size"), best.alias("_best")).where("group_size > 1")
        joined = cur.join(groups, ["_gid", "_digit", "_ended"]).select(
            "_uid", "_id", "_cp", F.col("_new").alias("_gid"), "_ended", "group_size",
            F.col("_best.u").alias("keep_uid"), F.col("_best.i").alias("keep_id"),
            F.when(~F.col("_ended"), F.expr(f"substring(_rest, {size + 1})")).alias("_rest"))
        joined = stage(joined, "radix")
        done.append(joined.where("_ended").select("_uid", "keep_uid", "keep_id", "group_size"))
        cur = joined.where("not _ended").select("_uid", "_id", "_cp", "_gid", "_rest")
        if cur.isEmpty():
            return reduce(DataFrame.unionByName, done)
        size *= GROWTH


def radix_rows(keyed: DataFrame, doc_id: str = "doc_id", text: str = "text"):
    return keyed.select("_uid", F.col(doc_id).alias("_id"), F.coalesce(F.length(text), F.lit(0)).alias("_cp"),
                        F.encode(normalised(text), "UTF-8").alias("_norm"))


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    A null text counts as empty, so null, empty and all-white-space texts are
    one group. Repeated rows (even of one doc_id) are copies like any other:
    exactly one of them is kept. Other columns of docs play no part."""
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.length(text), F.lit(0)).alias("_cp"),
                       F.encode(normalised(text), "UTF-8").alias("_norm"))
    rows = with_row_ids(rows.withColumn("_sha", F.sha2("_norm", 256)), "radix-rows")
    groups = duplicate_groups(rows)
    out = rows.select("_uid", "_id", "_sha").join(groups, "_uid", "left")
    alone = F.col("keep_uid").isNull()
    return out.select(F.col("_id").alias("doc_id"), F.when(alone, F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                      F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                      (alone | (F.col("keep_uid") == F.col("_uid"))).alias("kept"), F.col("_sha").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """docs without the copies, all columns as they were, whatever their names."""
    names = docs.columns
    own = {c: f"c{i}" for i, c in enumerate(names)}
    with scratch() as keep:
        keyed = with_row_ids(numbered(docs), "dedup-docs")
        copies = stage(duplicate_groups(radix_rows(keyed, own["doc_id"], own["text"])).where("_uid <> keep_uid").select("_uid"), "dedup-copies")
        keep |= {keyed.staged_at, copies.staged_at}
    return keyed.join(copies, "_uid", "left_anti").drop("_uid").toDF(*names)
