"""Token counts of documents in flat, unindexed token files.

A token file is a run of fixed-width little-endian ids in which each document is
followed by an end-of-document id; nothing says where documents begin. The files
are read in blocks of fixed size that pay no heed to documents. Each block is
searched on its own (one vectorised comparison); a prefix scan over the blocks'
totals (separators so far, place of the last one) then gives every separator its
number in the file and its document's start, so a document may span any number
of blocks. The scan runs on groups of blocks and then on the groups, so no file
is too long for it.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices, stage
from .vocab import ChunkTable, chunk_text, runs, space_chunks

BLOCK_TOKENS = 1 << 16
GROUP_SHIFT = 12   # 4096 blocks in a group of the scan


def read_token_files(spark: SparkSession, path: str, block_bytes: int = 2 * BLOCK_TOKENS) -> DataFrame:
    """Blocks (shard, block, data) of the flat files under path, in any store
    that Spark reads. A file is one row of Spark's binaryFile source, so files
    should be shards of at most some hundred MB, as training writes them."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", "content")
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(block_bytes).cast("long")))
    return files.withColumn("_at", at).select(
        F.col("path").alias("shard"), F.expr(f"_at div {block_bytes}").alias("block"),
        F.expr(f"substring(content, cast(_at + 1 as int), {block_bytes})").alias("data"))


def find_separators(blocks: DataFrame, eod: int, dtype: str = "<u2") -> DataFrame:
    """shard, block, n (ids in the block), eods (places of the separators in it)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            ids = [np.frombuffer(d or b"", dtype) for d in batch.column("data").to_pylist()]
            hits = [np.flatnonzero(x == eod) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("block"), pa.array([len(x) for x in ids], pa.int64()), pa.array(hits, pa.list_(pa.int64()))],
                names=["shard", "block", "n", "eods"])

    kind = blocks.schema["shard"].dataType.simpleString()
    return blocks.select("shard", F.col("block").cast("long").alias("block"), "data") \
        .mapInArrow(run, f"shard {kind}, block bigint, n bigint, eods array<bigint>")


def count_documents(found: DataFrame) -> DataFrame:
    """found: as from find_separators. One row per document: shard, doc_no (from
    0), start, n_tokens (without the separator), terminated. Ids after the last
    separator are a document that isn't terminated; a file without ids has none."""
    found = stage(found.select("shard", "block", "n", "eods", F.shiftright("block", GROUP_SHIFT).alias("_g")), "token-separators")   # read twice
    before = Window.partitionBy("shard", "_g").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    group_before = Window.partitionBy("shard").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.size("eods") > 0, F.element_at("eods", -1))
    groups = found.withColumn("_at", F.coalesce(F.sum("n").over(before), F.lit(0))).groupBy("shard", "_g").agg(
        F.sum("n").alias("n"), F.sum(F.size("eods")).alias("k"), F.max(F.col("_at") + last).alias("last"))
    groups = groups.withColumn("_n0", F.coalesce(F.sum("n").over(group_before), F.lit(0))) \
        .withColumn("_k0", F.coalesce(F.sum("k").over(group_before), F.lit(0))) \
        .withColumn("_last0", F.max(F.col("_n0") + F.col("last")).over(group_before)) \
        .withColumn("_tail", F.row_number().over(Window.partitionBy("shard").orderBy(F.desc("_g"))) == 1) \
        .select("shard", "_g", "_n0", "_k0", "_last0", "_tail")
    t = found.join(groups, ["shard", "_g"])
    t = t.withColumn("_base", F.col("_n0") + F.coalesce(F.sum("n").over(before), F.lit(0))) \
        .withColumn("_no", F.col("_k0") + F.coalesce(F.sum(F.size("eods")).over(before), F.lit(0))) \
        .withColumn("_prev", F.coalesce(F.max(F.col("_base") + last).over(before), F.col("_last0"), F.lit(-1))) \
        .withColumn("_final", F.col("_tail") & (F.row_number().over(Window.partitionBy("shard", "_g").orderBy(F.desc("block"))) == 1))
    # the separator of a document without one would stand right after the file's last id
    ends = F.when(F.col("_final") & (F.coalesce(last, F.lit(-1)) < F.col("n") - 1)
                  | F.col("_final") & (F.size("eods") == 0) & (F.col("_prev") < F.col("_base") + F.col("n") - 1),
                  F.concat("eods", F.array("n"))).otherwise(F.col("eods"))
    t = t.select("shard", "_base", "_no", "_prev", "n", "_final", ends.alias("_ends"))
    t = t.select("*", F.posexplode("_ends").alias("_i", "_end"))
    start = F.when(F.col("_i") == 0, F.col("_prev") + 1).otherwise(F.col("_base") + F.expr("_ends[_i - 1]") + 1)
    end = F.col("_base") + F.col("_end")
    return t.select("shard", (F.col("_no") + F.col("_i")).alias("doc_no"), start.alias("start"), (end - start).alias("n_tokens"),
                    (F.col("_end") < F.col("n")).alias("terminated"))


@lru_cache(maxsize=2)
def _table(tokenizer: str) -> ChunkTable:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer)
    t.encode_special_tokens = True   # a separator's string in a text is ordinary text
    return ChunkTable(lambda chunks: runs(chunks, [e.ids for e in t.encode_batch_fast([*map(chunk_text, chunks)], add_special_tokens=False)]))


def write_token_shards(docs: DataFrame, tokenizer: str, eod: int, doc_id: str = "doc_id", text: str = "text",
                       block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """Encode docs into flat shards, one per task, stored block by block:
    (blocks: shard, block, data), and apart from them which documents went into
    a shard and in which order (manifest: shard, doc_no, doc_id). tokenizer: a
    byte-level tokenizers file of fewer than 65,536 ids. A null text is a document of no tokens."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, shard = _table(tokenizer), TaskContext.get().partitionId()
        rest, block, doc_no = np.empty(0, "<u2"), 0, 0
        ids_type = pa.list_(schema_type)

        def rows(blobs: list[bytes], first: int, no: int, ids: pa.Array | None) -> pa.RecordBatch:
            n = len(blobs) + (ids is not None)
            lists = [None] * len(blobs) + ([ids.to_pylist()] if ids is not None else [])
            return pa.RecordBatch.from_arrays(
                [pa.array([shard] * n, pa.int32()), pa.array([*range(first, first + len(blobs)), *([no] * (n - len(blobs)))], pa.int64()),
                 pa.array([*blobs, *([None] * (n - len(blobs)))], pa.binary()), pa.array(lists, ids_type)], names=["shard", "block", "data", "ids"])

        for batch in slices(batches):
            encoded = table.encode_docs([space_chunks(t or "") for t in batch.column("text").to_pylist()])
            stream = np.concatenate([rest, *(x for r in encoded for x in (r.astype("<u2"), np.array([eod], "<u2")))])
            full = len(stream) // block_tokens
            blobs = [stream[i * block_tokens:(i + 1) * block_tokens].tobytes() for i in range(full)]
            yield rows(blobs, block, doc_no, batch.column("doc_id"))
            rest, block, doc_no = stream[full * block_tokens:], block + full, doc_no + batch.num_rows
        if len(rest):
            yield rows([rest.tobytes()], block, 0, None)

    narrow = docs.selectExpr(f"`{doc_id}` as doc_id", f"`{text}` as text")
    schema_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    stored = stage(narrow.mapInArrow(run, f"shard int, block bigint, data binary, ids array<{kind}>"), "token-shards")
    manifest = stored.where("ids is not null").select("shard", "block", F.posexplode("ids").alias("_i", "doc_id")) \
        .select("shard", (F.col("block") + F.col("_i")).alias("doc_no"), "doc_id")
    return stored.where("data is not null").select("shard", "block", "data"), manifest


def document_token_counts(docs: DataFrame, tokenizer: str, eod: int) -> DataFrame:
    """doc_id, n_tokens, shard, doc_no, start for every row of docs, by way of
    flat shards and the separator scan. Null doc_ids and repeated rows are
    documents like any other; without rows there are no shards and no result."""
    blocks, manifest = write_token_shards(docs, tokenizer, eod)
    counted = count_documents(find_separators(blocks, eod))
    return manifest.join(counted, ["shard", "doc_no"]).select("doc_id", "n_tokens", "shard", "doc_no", "start")
