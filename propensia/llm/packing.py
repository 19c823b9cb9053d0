"""Packing of token sequences by exact-complement hashing.

Documents are cut into pieces of at most one sequence; only the pieces' lengths
matter for packing, and there are at most ``capacity`` different ones. The plan
is made from the counts of lengths alone: the longest piece left opens a
sequence; if the gap is the length of a piece on hand, or the sum of two or
three, that combination closes it exactly (an index says for every sum how many
pairs of lengths on hand make it); else the best-fitting (longest) piece
goes in and the smaller gap is tried again. A pattern found in this way is used
as many times as the counts allow, which uses up one of its lengths, so the plan
has some ``capacity * log(capacity)`` patterns at most, however many documents
there are. Pieces then find their places by their rank among the pieces of
equal length; ranks are taken in salted groups, so a length that a third of all
pieces share is no hot key.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, slices, stage
from .vocab import ChunkTable, Runs, runs

CAPACITY = 4096
END_ID = 1

_SEPARATORS = re.compile("[\x1c-\x1f]")   # white space for str.split(), but not for the tokenizer
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def word_chunks(text: str) -> list[str]:
    """Cut at white space, where this vocabulary always cuts, and put Latin-1
    text in lower case, as its normaliser would (elsewhere lower case may
    depend on the Unicode version and is left to the library)."""
    try:
        text.encode("latin-1")
        text = text.lower()
    except UnicodeEncodeError:
        pass
    return _WORDS.findall(text) if _SEPARATORS.search(text) else text.split()


JOINED = 256   # words in one call of the library


@lru_cache(maxsize=2)
def _table(tokenizer: str) -> ChunkTable:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer)
    t.encode_special_tokens = True   # special tokens' strings in a text are ordinary text
    closes = np.array([str(t.id_to_token(i)).endswith("</w>") for i in range(t.get_vocab_size())])

    def encode(chunks: list[str]) -> Runs:
        # A chunk of letters is one word and ends with its only id that closes a
        # word, so many of them can go through the library as one text.
        words = [c for c in chunks if c.isalpha()]
        texts = [" ".join(words[i:i + JOINED]) for i in range(0, len(words), JOINED)]
        flat = np.array([i for e in t.encode_batch_fast(texts, add_special_tokens=False) for i in e.ids], np.uint32)
        ends = np.flatnonzero(closes[flat]) + 1
        if len(ends) != len(words):   # the library's Unicode version knows other letters
            words, flat, ends = [], flat[:0], ends[:0]
        done = set(words)
        rest = [c for c in chunks if c not in done]
        rest, ids, lens = runs(rest, [e.ids for e in t.encode_batch_fast(rest, add_special_tokens=False)])
        return words + rest, np.concatenate([flat, ids]), np.concatenate([np.diff(ends, prepend=0), lens])

    return ChunkTable(encode, tails="")


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit) of every
    document's ids and the end id after them, cut every capacity ids. A null or
    empty text is the end id alone; repeated rows are documents like any other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(tokenizer)
        for batch in slices(batches):
            encoded = table.encode_docs([word_chunks(t or "") for t in batch.column("text").to_pylist()])
            row, piece, start, length, data = [], [], [], [], []
            for i, ids in enumerate(encoded):
                ids = np.append(ids, end_id).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at:at + capacity]
                    row.append(i), piece.append(k), start.append(at), length.append(len(part)), data.append(part.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(data, pa.binary())], names=["doc_id", "piece", "start", "length", "ids"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.selectExpr(f"`{doc_id}` as doc_id", f"`{text}` as text") \
        .mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary")


class _Lengths:
    """Counts of lengths on hand, and which of them add up to a gap. pairs[s]: how many
    pairs of lengths (a length with itself needs two pieces) on hand have the sum s;
    a single length is its own sum, and a triple is a length and a pair of the rest."""

    def __init__(self, counts: np.ndarray):
        self.left = np.zeros_like(counts)
        self.pairs = np.zeros(2 * len(counts), np.int64)
        for n in np.flatnonzero(counts):
            self.change(int(n), int(counts[n]))

    def change(self, n: int, by: int) -> None:
        """by more (or fewer) pieces of length n; the pair sums follow."""
        had, has = int(self.left[n]), int(self.left[n]) + by
        if (had > 0) != (has > 0):
            self.left[n] = 0
            self.pairs[n + np.flatnonzero(self.left)] += 1 if has > 0 else -1
        if (had > 1) != (has > 1):
            self.pairs[2 * n] += 1 if has > 1 else -1
        self.left[n] = has

    def longest(self, most: int) -> int:
        at = np.flatnonzero(self.left[:most + 1])
        return int(at[-1]) if len(at) else 0

    def pair(self, gap: int, most: int) -> tuple[int, ...]:
        """Two lengths of sum gap, the longer one as long as can be and at most most."""
        if not self.pairs[gap]:
            return ()
        a = np.arange(min(most, gap - 1), (gap - 1) // 2, -1)
        ok = (self.left[a] > 0) & (self.left[gap - a] > np.where(2 * a == gap, 1, 0))
        at = np.flatnonzero(ok)
        return (int(a[at[0]]), gap - int(a[at[0]])) if len(at) else ()

    def complement(self, gap: int) -> tuple[int, ...]:
        """One, two or three lengths of sum gap, or none."""
        if self.left[gap]:
            return (gap,)
        if two := self.pair(gap, gap - 1):
            return two
        longest = np.flatnonzero(self.left[:gap - 1])[::-1]
        longest = longest[3 * longest >= gap]
        for a in longest[self.pairs[gap - longest] > 0]:
            self.left[a] -= 1   # its own piece is no part of the pair
            two = self.pair(gap - int(a), int(a))
            self.left[a] += 1
            if two:
                return (int(a), *two)
        return ()


def pack_plan(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, times) that use every piece; counts[n]: pieces of length n."""
    on_hand, plan = _Lengths(counts), []
    while top := on_hand.longest(capacity):
        items, gap = [], capacity
        take: tuple[int, ...] = (top,)
        while take:
            for n in take:
                on_hand.change(n, -1)
                items.append(n)
                gap -= n
            take = ()
            if gap:
                take = on_hand.complement(gap)
                if not take and (best := on_hand.longest(gap)):
                    take = (best,)
        need = Counter(items)
        times = 1 + min(int(on_hand.left[n]) // k for n, k in need.items())
        for n, k in need.items():
            on_hand.change(n, -(times - 1) * k)
        plan.append((tuple(sorted(items, reverse=True)), times))
    return plan


def _places(plan: list[tuple[tuple[int, ...], int]], capacity: int) -> tuple[np.ndarray, ...]:
    """For each run of pieces of one length in one pattern: length * 2^40 + first
    rank, first sequence, pieces of this length in the pattern, offset of the first."""
    used, sequence, rows = np.zeros(capacity + 1, np.int64), 0, []
    for items, times in plan:
        offset = 0
        for n, k in sorted(Counter(items).items(), reverse=True):
            rows.append(((n << 40) + int(used[n]), sequence, k, offset))
            used[n] += times * k
            offset += n * k
        sequence += times
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else tuple(np.zeros(0, np.int64) for _ in range(4))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces (with a column length, 1 to capacity) and, for each row, its
    sequence_id and its offset there. Without rows there are no sequences."""
    spark = pieces.sparkSession
    names = pieces.columns
    rows = pieces.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("_length", F.col(f"c{names.index('length')}")) \
        .withColumn("_u", F.monotonically_increasing_id())
    rows = stage(rows.withColumn("_salt", F.pmod(F.xxhash64("_u"), F.lit(4 * partitions(spark)))), "pieces")
    groups = rows.groupBy("_length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    counts = np.zeros(capacity + 1, np.int64)
    for n, k in groups.groupBy("_length").agg(F.sum("_n")).collect():   # at most capacity rows
        counts[n] = k
    key, first, copies, offset = _places(pack_plan(counts, capacity), capacity)
    before = Window.partitionBy("_length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("_length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_length", "_salt").orderBy("_u")
    ranked = rows.withColumn("_rank", F.row_number().over(inside) - 1).join(groups, ["_length", "_salt"]) \
        .withColumn("_rank", F.col("_rank") + F.col("_base"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("_length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            run = np.searchsorted(key, (n << 40) + rank, "right") - 1
            t = rank - (key[run] & ((1 << 40) - 1))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(names))), pa.array(first[run] + t // copies[run]), pa.array(offset[run] + t % copies[run] * n)],
                names=[f"c{i}" for i in range(len(names) + 2)])

    kinds = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(pieces.schema.fields)]
    more = [f"c{len(names)} bigint", f"c{len(names) + 1} bigint"]
    return ranked.select(*[f"c{i}" for i in range(len(names))], "_length", "_rank").mapInArrow(place, ", ".join(kinds + more)) \
        .toDF(*names, "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of docs with ids replaced by their CRC-32: doc_id, piece, start,
    length, ids_crc32, sequence_id, offset."""
    pieces = token_pieces(docs, tokenizer, capacity)
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity)
