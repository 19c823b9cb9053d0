"""Byte-level BPE: encoding with offsets, and decoding.

A rank file gives each token's bytes and its rank. The tokenizers library works
on characters, so every byte stands for one character (printable Latin-1 bytes
for themselves, the others from U+0100 up) and every way to join two tokens into
a third becomes a merge of that token's rank. Offsets come from the tokens' byte
lengths and the map from bytes to characters of the text: a token that holds
part of a character spans the whole character. Decoding goes back through the
byte table; a decoder for pieces of a stream keeps the bytes of a character that
is split between two pieces until it is complete.
"""

from __future__ import annotations

import base64
import codecs
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices
from .vocab import ChunkTable, chunk_text, runs, space_chunks


def byte_to_char() -> list[str]:
    """The character that stands for each byte."""
    own = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=4)
def load_ranks(path: str) -> list[bytes]:
    """Token bytes by id."""
    with open(path, "rb") as f:
        rows = [line.split() for line in f if line.strip()]
    by_id = {int(rank): base64.b64decode(token) for token, rank in rows}
    return [by_id[i] for i in range(len(by_id))]


class ByteBPE:
    """One rank file. pattern: the split made before merging."""

    def __init__(self, ranks: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark's tasks are the parallelism
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        self.tokens = load_ranks(ranks)
        self.rank = {t: i for i, t in enumerate(self.tokens)}
        chars = byte_to_char()
        name = [t.decode("latin-1").translate(dict(enumerate(chars))) for t in self.tokens]
        merges = [(name[self.rank[t[:k]]], name[self.rank[t[k:]]]) for t in self.tokens for k in range(1, len(t))
                  if t[:k] in self.rank and t[k:] in self.rank]
        self.library = Tokenizer(models.BPE(vocab={n: i for i, n in enumerate(name)}, merges=merges, ignore_merges=True))
        self.library.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.table = ChunkTable(lambda chunks: runs(chunks, [e.ids for e in self.library.encode_batch_fast([*map(chunk_text, chunks)], add_special_tokens=False)]))
        self.lens = np.array([len(t) for t in self.tokens], np.int64)
        self.starts = np.cumsum(self.lens) - self.lens
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.table.encode_docs([space_chunks(t) for t in texts])

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-end code point of each token."""
        raw = np.frombuffer(text.encode(), np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1   # character that a byte belongs to
        ends = np.cumsum(self.lens[ids])
        return char[ends - self.lens[ids]], char[ends - 1] + 1

    def decode(self, ids: np.ndarray) -> bytes:
        n = self.lens[ids]
        ends = np.cumsum(n)
        if not len(n):
            return b""
        return self.bytes[np.repeat(self.starts[ids] - ends + n, n) + np.arange(ends[-1])].tobytes()

    def decode_stream(self, pieces: Iterable[np.ndarray]) -> Iterator[str]:
        """Text of ids that come piece by piece; a character split between two
        pieces comes out with the later one, bytes that are no UTF-8 as U+FFFD."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for ids in pieces:
            yield decoder.decode(self.decode(np.asarray(ids, np.int64)))
        yield decoder.decode(b"", final=True)


@lru_cache(maxsize=2)
def byte_bpe(ranks: str, pattern: str) -> ByteBPE:
    """One per Python worker."""
    return ByteBPE(ranks, pattern)


def _with_lists(batch: pa.RecordBatch, keep: list[str], lists: dict[str, list[np.ndarray]]) -> pa.RecordBatch:
    def column(arrays: list[np.ndarray]) -> pa.Array:
        ends = np.cumsum([0, *map(len, arrays)])
        flat = np.concatenate([np.empty(0, np.int32), *arrays]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *map(column, lists.values())], names=[*keep, *lists])


def encode_texts(docs: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text",
                 offsets: bool = True) -> DataFrame:
    """doc_id, ids and, if asked for, starts and ends (code points) for each row.

    Null and empty texts have no ids. Repeated rows come out repeated, no rows
    in gives no rows out; other columns of docs play no part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(ranks, pattern)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            lists = {"ids": bpe.encode(texts)}
            if offsets:
                spans = [bpe.offsets(t, i) for t, i in zip(texts, lists["ids"])]
                lists |= {"starts": [s for s, _ in spans], "ends": [e for _, e in spans]}
            yield _with_lists(batch, ["doc_id"], lists)

    kind = docs.schema[doc_id].dataType.simpleString()
    more = ", starts array<int>, ends array<int>" if offsets else ""
    return docs.selectExpr(f"`{doc_id}` as doc_id", f"`{text}` as text").mapInArrow(run, f"doc_id {kind}, ids array<int>{more}")


def decode_ids(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, ids and data (the decoded bytes); null ids decode to no bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(ranks, pattern)
        for batch in slices(batches):
            ids = batch.column("ids")
            flat, ends = ids.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *(len(x) if x.is_valid else 0 for x in ids)])
            data = [bpe.decode(flat[a:b]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(data, pa.binary())], names=["doc_id", "ids", "data"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, data binary")


STREAM_IDS = 4096   # ids that a stream brings at a time


def decode_texts(encoded: DataFrame, ranks: str, pattern: str, piece_ids: int = STREAM_IDS) -> DataFrame:
    """All columns of encoded and text, decoded piece by piece as from a stream: a character
    whose bytes two pieces share is put together, bytes that are no UTF-8 become U+FFFD.
    Null ids decode to an empty text. A column text of encoded is replaced."""
    keep = [c for c in encoded.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(ranks, pattern)
        for batch in slices(batches):
            ids = batch.column("ids")
            flat, ends = ids.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *(len(x) if x.is_valid else 0 for x in ids)])
            texts = ["".join(bpe.decode_stream(flat[at:min(at + piece_ids, b)] for at in range(a, b, piece_ids))) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())], names=[*keep, "text"])

    kinds = [f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in keep]
    return encoded.select(*keep).mapInArrow(run, ", ".join([*kinds, "text string"]))
