"""Exact n-gram Jaccard join by token-combination prefixes.

Documents are sets of hashed 4-word shingles ("tokens"); two link when 100 *
intersection >= 85 * union. A set of n tokens can miss e = n - ceil(0.85 n) of
them in a partner. In one global order (by hash) the first f = e + k tokens of
two linked sets share at least k tokens, where k = e + 1, so

1. only the prefixes are counted over the corpus: batch by batch, then by ranges
   of tokens; a token sends one entry per batch, so a passage that a third of
   all documents share is no hot key. Sets of which too few prefix tokens occur
   elsewhere cannot link and are done;
2. the others are indexed by their prefix tokens that occur elsewhere: rare ones
   singly, frequent ones as pairs. All pairs are not needed: the frequent
   tokens are dealt into fewer than k classes by hash, so k shared ones put two
   into one class, and only pairs inside a class are keys. A set with fewer than
   k frequent tokens shares a rare one with every partner and has no pairs: text
   that many documents hold beside their own puts none of them into long lists.
   Sets of which too few keys occur elsewhere go once more;
3. short lists of the index give candidate pairs, which must also share enough
   keys; the sets in long lists (groups of near copies) are put into blocks, and
   blocks that share a long list are compared as matrices, pair of blocks by
   pair of blocks, which returns a spanning forest and counts, not pairs;
4. candidates are verified on their whole sets, fetched for them alone, in rounds
   of bounded size: the disk that a round takes is free before the next one.

Equal sets are one class from the start. Links are joined into components by
alternating large-star and small-star steps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import let_go, numbered, scratch, slices, stage, with_row_ids
from .vocab import ChunkTable, Runs

WORDS = 4
PERCENT = 85
RARE = 64          # a token in more documents than this is frequent; lists of at most this many classes are short
BLOCK = 1024       # classes in a block, and
BLOCK_TOKENS = 1 << 21   # tokens of their sets: both bound a task's memory
STRIP = 2048       # tokens of a matrix that compares blocks
BATCH_ROWS, BATCH_TOKENS = 4096, 1 << 18   # rows and prefix tokens of a batch
PART_TOKENS = 1 << 20   # prefix tokens that one range counts, on average at most
ROUND_TOKENS = 1 << 24   # tokens that one round of fetching or comparing sends, or as many as all prefixes have
LEAST = -(-PERCENT // (100 - PERCENT))   # smaller sets link with equal ones only
U64 = np.uint64


def misses(n):
    return n - (PERCENT * n + 99) // 100


def shared(n):
    """Tokens that the prefixes of two linked sets share, if n is the smaller size."""
    return misses(n) + 1


def smallest_partner(n):
    return (PERCENT * n + 99) // 100


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def join_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * U64(0x9E3779B97F4A7C15) + b)


def _word_hashes(words: list[bytes]) -> Runs:
    flat = np.fromiter(map(xxhash.xxh64_intdigest, words), U64, len(words))
    return words, flat.view(np.uint32), np.full(len(words), 2, np.int64)


@lru_cache(maxsize=1)
def _words() -> ChunkTable:
    return ChunkTable(_word_hashes)


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles."""
    words = [t.encode().lower().split() for t in texts]   # bytes: ASCII letters and white space only
    out = []
    for ids in _words().encode_docs(words):
        h = np.ascontiguousarray(ids).view(U64)
        if len(h) >= WORDS:
            key = h[:len(h) - WORDS + 1]
            for k in range(1, WORDS):
                key = join_hash(key, h[k:len(h) - WORDS + 1 + k])
        else:   # fewer words: the whole sequence, told apart from whole shingles by its length
            key = h[:1] + U64(len(h))
            for k in range(1, len(h)):
                key = join_hash(key, h[k:k + 1])
        out.append(np.unique(key))
    return out


def digest(tokens: np.ndarray) -> bytes:
    """128 bits of a set."""
    return np.array([mix(tokens).sum(dtype=U64), np.bitwise_xor.reduce(mix(tokens + U64(0x5851F42D4C957F2D)))], U64).tobytes()


def _batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _members(docs: DataFrame) -> DataFrame:
    """doc_id, th, batch, n, dig, prefix (little-endian 64-bit tokens) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, tokens = TaskContext.get().partitionId() << 32, 0, 0
        for b in slices(batches):
            sets = shingle_sets([t or "" for t in b.column("text").to_pylist()])
            n, of = [len(s) for s in sets], []
            for k in n:
                size = int(misses(k) + shared(k))
                if rows == BATCH_ROWS or rows and tokens + size > BATCH_TOKENS:
                    number, rows, tokens = number + 1, 0, 0
                rows, tokens = rows + 1, tokens + size
                of.append(number)
            yield _batch({"doc_id": b.column("doc_id"), "th": b.column("th"), "batch": pa.array(of, pa.int64()),
                          "n": pa.array(n, pa.int64()), "dig": pa.array([digest(s) for s in sets], pa.binary()),
                          "prefix": pa.array([s[:misses(k) + shared(k)].tobytes() for s, k in zip(sets, n)], pa.binary())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stage(docs.mapInArrow(run, f"doc_id {kind}, th bigint, batch bigint, n bigint, dig binary, prefix binary"), "join-members")


def _tokens(blob: bytes | None) -> np.ndarray:
    return np.frombuffer(blob or b"", U64)


def _prefix_counts(members: DataFrame, n_parts: int) -> DataFrame:
    """part, batch, toks, cnt: each batch's distinct prefix tokens and in how many of its distinct sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, BATCH_ROWS):
            ids, digs, blobs = (b.column(c).to_pylist() for c in ("batch", "dig", "prefix"))
            for batch in sorted(set(ids)):
                sets = {d: p for i, d, p in zip(ids, digs, blobs) if i == batch}
                tok, cnt = np.unique(np.concatenate([_tokens(p) for p in sets.values()]), return_counts=True)
                part = ((tok >> U64(40)) * U64(n_parts)) >> U64(24)   # ranges of tokens; tok is sorted
                edges = np.searchsorted(part, np.arange(n_parts + 1, dtype=U64))
                rows = [(p, x, y) for p, (x, y) in enumerate(zip(edges, edges[1:])) if x < y]
                cnt = np.minimum(cnt, 255).astype(np.uint8)
                yield _batch({"part": pa.array([p for p, _, _ in rows], pa.int32()), "batch": pa.array([batch] * len(rows), pa.int64()),
                              "toks": pa.array([tok[x:y].tobytes() for _, x, y in rows], pa.binary()),
                              "cnt": pa.array([cnt[x:y].tobytes() for _, x, y in rows], pa.binary())})

    return members.select("batch", "dig", "prefix").mapInArrow(run, "part int, batch bigint, toks binary, cnt binary")


def _repeated(counts: DataFrame) -> DataFrame:
    """batch, toks, freq: of each batch's tokens those in two sets or more, and which are frequent."""
    def run(t: pa.Table) -> pa.Table:
        ids, toks = t["batch"].to_pylist(), [_tokens(x) for x in t["toks"].to_pylist()]
        tok, of = np.concatenate(toks), np.repeat(np.arange(len(ids)), [len(x) for x in toks])
        order = np.argsort(tok, kind="stable")   # its runs are sorted already
        new = np.concatenate([[True], tok[order[1:]] != tok[order[:-1]]])
        cnt = np.concatenate([np.frombuffer(x, np.uint8) for x in t["cnt"].to_pylist()])
        total = np.empty(len(tok), np.int64)
        total[order] = np.add.reduceat(cnt[order].astype(np.int64), np.flatnonzero(new))[np.cumsum(new) - 1]
        keep = total >= 2
        tok, of, frequent = tok[keep], of[keep], (total[keep] > RARE).astype(np.uint8)
        at = np.searchsorted(of, np.arange(len(ids) + 1))
        rows = [(ids[i], x, y) for i, (x, y) in enumerate(zip(at, at[1:])) if x < y]
        return pa.table({"batch": pa.array([i for i, _, _ in rows], pa.int64()), "toks": pa.array([tok[x:y].tobytes() for _, x, y in rows], pa.binary()),
                         "freq": pa.array([frequent[x:y].tobytes() for _, x, y in rows], pa.binary())})

    return counts.groupBy("part").applyInArrow(run, "batch bigint, toks binary, freq binary")


def _linkable(members: DataFrame, repeated: DataFrame) -> DataFrame:
    """dig, n, doc_id, th, toks, freq of the sets with enough repeated prefix tokens, one row per set."""
    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        tok = np.concatenate([np.empty(0, U64), *map(_tokens, found["toks"].to_pylist())])
        frequent = np.concatenate([np.empty(0, np.uint8), *(np.frombuffer(x, np.uint8) for x in found["freq"].to_pylist())])
        order = np.argsort(tok)
        tok, frequent, rows, seen = tok[order], frequent[order], [], set()
        for i, (dig, n, blob) in enumerate(zip(own["dig"].to_pylist(), own["n"].to_pylist(), own["prefix"].to_pylist())):
            if n >= LEAST and dig not in seen and len(tok):
                p = _tokens(blob)
                at = np.minimum(np.searchsorted(tok, p), len(tok) - 1)
                hit = tok[at] == p
                if hit.sum() >= shared(smallest_partner(n)):
                    rows.append((i, p[hit].tobytes(), frequent[at[hit]].tobytes()))
            seen.add(dig)
        table = own.select(["dig", "n", "doc_id", "th"]).take(pa.array([r[0] for r in rows], pa.int64()))
        return table.append_column("toks", pa.array([r[1] for r in rows], pa.binary())).append_column("freq", pa.array([r[2] for r in rows], pa.binary()))

    kind = members.schema["doc_id"].dataType.simpleString()
    found = members.select("batch", "dig", "n", "doc_id", "th", "prefix").groupBy("batch").cogroup(repeated.groupBy("batch")) \
        .applyInArrow(run, f"dig binary, n bigint, doc_id {kind}, th bigint, toks binary, freq binary")
    # The flags of a token are the same in all batches, so any row of a set will do.
    best = F.min(F.struct("n", F.col("doc_id").isNull().alias("z"), "doc_id", "th", "toks", "freq")).alias("r")
    return found.groupBy("dig").agg(best).select("dig", "r.n", "r.doc_id", "r.th", "r.toks", "r.freq")


def index_keys(tokens: np.ndarray, frequent: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set and which of them are rare single tokens."""
    rare, often = tokens[~frequent], tokens[frequent]
    keys, low = [rare], int(shared(smallest_partner(n)))
    if len(often) < low:   # whatever set it links with, they share a rare token
        return rare, np.ones(len(rare), bool)
    if shared(smallest_partner(smallest_partner(n))) <= 1:   # a partner may be too small for pairs
        keys.append(often)
    if low >= 2:
        group = mix(often) & U64((1 << ((low - 1).bit_length() - 1)) - 1)   # at most low - 1 classes, nested for all sizes
        order = np.lexsort((often, group))
        often, group = often[order], group[order]
        lag = 1
        while lag < len(often) and (same := group[lag:] == group[:-lag]).any():
            keys.append(join_hash(often[:-lag][same], often[lag:][same]))
            lag += 1
    flat = np.concatenate(keys)
    return flat, np.arange(len(flat)) < len(rare)


def _index(classes: DataFrame) -> DataFrame:
    """key, rare, cls, n, fq (frequent tokens of the set's prefix)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = []
            for cls, n, toks, freq in zip(*(b.column(c).to_pylist() for c in ("_uid", "n", "toks", "freq"))):
                often = np.frombuffer(freq, np.uint8) > 0
                keys, rare = index_keys(_tokens(toks), often, n)
                out.append((keys, rare, np.full(len(keys), cls), np.full(len(keys), n), np.full(len(keys), often.sum())))
            if out:
                keys, rare, *rest = (np.concatenate(c) for c in zip(*out))
                yield _batch({"key": pa.array(keys.view(np.int64)), "rare": pa.array(rare)} | {k: pa.array(c.astype(np.int64)) for k, c in zip(("cls", "n", "fq"), rest)})

    return classes.select("_uid", "n", "toks", "freq").mapInArrow(run, "key bigint, rare boolean, cls bigint, n bigint, fq bigint")


def _shared_sql(n: str) -> str:
    """shared(n) in SQL."""
    return f"({n} - ({PERCENT} * {n} + 99) div 100 + 1)"


def _promising(postings: DataFrame) -> DataFrame:
    """The postings of the sets that still have enough tokens which occur in other sets. Up to
    here a token also counted as repeated if only rows of one and the same set hold it."""
    enough = postings.groupBy("cls").agg(F.sum(F.col("rare").cast("long")).alias("c"), F.max("fq").alias("q"), F.max("n").alias("n")) \
        .where(f"c + q >= {_shared_sql(f'(({PERCENT} * n + 99) div 100)')}").select("cls")
    return postings.join(enough, "cls", "left_semi")


def _candidates(own: DataFrame, postings: DataFrame) -> DataFrame:
    """a < b of short lists that fit in size and share enough keys, a of the postings own, b of all; n: tokens of a."""
    a, b = (df.where(F.col("m") <= RARE).select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("rare", "cls", "n", "fq")]) for df, s in ((own, "a"), (postings, "b")))
    low, high = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    pairs = a.join(b, "key").where((F.col("cls_a") < F.col("cls_b")) & (100 * low >= PERCENT * high))
    need = F.expr(_shared_sql("least(n_a, n_b)"))
    return pairs.groupBy(F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).agg(
        F.sum(F.col("rare_a").cast("long")).alias("c"), F.max(F.least("fq_a", "fq_b")).alias("q"), F.max(need).alias("need"), F.max("n_a").alias("n")) \
        .where("c + q >= need").select("a", "b", "n")


def _blocks(postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the classes in long lists: (cls, blk, n) and the pairs of blocks (x <= y) that share a long list."""
    long = postings.where(F.col("m") > RARE).select("key", "cls", "n", "m", "t")
    home = long.groupBy("cls").agg(F.max(F.struct("m", "key", "t")).alias("h"), F.max("n").alias("n"))   # longest list first: few homes, full blocks
    blocks = stage(home.select("cls", F.xxhash64("h.key", F.pmod(F.xxhash64("cls"), F.ceil(F.greatest(F.col("h.m") / BLOCK, F.col("h.t") / BLOCK_TOKENS)))).alias("blk"), "n"), "join-blocks")
    in_list = stage(long.select("key", "cls").join(blocks, "cls").select("key", "blk").distinct(), "join-block-keys")
    x, y = in_list.withColumnRenamed("blk", "x"), in_list.withColumnRenamed("blk", "y")
    return blocks, stage(x.join(y, "key").where("x <= y").select("x", "y").distinct(), "join-block-pairs")


def _linked(n_a, n_b, both):
    return (100 * both >= PERCENT * (n_a + n_b - both)) & (both > 0)


def _rounds(df: DataFrame, by: list[str], tokens: int, most: int) -> list[DataFrame]:
    """df dealt by hash into parts of most tokens each, on average at most; it has so many tokens to send."""
    n = 1 + int(tokens or 0) // most
    return [df] if n == 1 else [df.where(F.pmod(F.xxhash64(*by), F.lit(n)) == i) for i in range(n)]


def _in_rounds(parts: list[DataFrame], step: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """What step makes of all parts, staged one after the other."""
    return reduce(DataFrame.union, [stage(step(part), name) for part in parts])


def _fetch(docs: DataFrame, who: DataFrame) -> DataFrame:
    """cls, copies, blk, toks (whole sets) of the classes in who, each of which has a row (_d, _t)."""
    texts = docs.join(who, docs["doc_id"].eqNullSafe(who["_d"]) & (docs["th"] == who["_t"])).select("cls", "copies", "blk", "text").dropDuplicates(["cls"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = shingle_sets([t or "" for t in b.column("text").to_pylist()])
            yield _batch({c: b.column(c) for c in ("cls", "copies", "blk")} | {"toks": pa.array([s.tobytes() for s in sets], pa.binary())})

    return texts.mapInArrow(run, "cls bigint, copies bigint, blk bigint, toks binary")


def _verify_pairs(pairs: DataFrame, sets: DataFrame, sent: int, most: int) -> DataFrame:
    """a, b, copies_a, copies_b of the pairs that link, staged. The sets are dealt by hash, and a round
    has the pairs of two deals: it sends those two once, and a's set again for each pair; sent: tokens in all."""
    deals = _rounds(sets, ["cls"], sent, 2 * most)
    near = []
    for i, own in enumerate(deals):
        for j, other in enumerate(deals):
            part = pairs.where((F.pmod(F.xxhash64("a"), F.lit(len(deals))) == i) & (F.pmod(F.xxhash64("b"), F.lit(len(deals))) == j)) if len(deals) > 1 else pairs
            near.append(stage(_linked_pairs(part, own, other), "join-links"))
    return reduce(DataFrame.union, near)


def _linked_pairs(pairs: DataFrame, own: DataFrame, other: DataFrame) -> DataFrame:
    """The pairs that link, with a's set in own and b's in other."""
    a, b = (sets.select(F.col("cls").alias(s), F.col("copies").alias(f"copies_{s}"), F.col("toks").alias(f"toks_{s}")) for sets, s in ((own, "a"), (other, "b")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in slices(batches):
            keep = []
            for x, y in zip(t.column("toks_a").to_pylist(), t.column("toks_b").to_pylist()):
                x, y = _tokens(x), _tokens(y)
                keep.append(bool(_linked(len(x), len(y), np.intersect1d(x, y, assume_unique=True).size)))
            yield t.filter(pa.array(keep, pa.bool_())).select(["a", "b", "copies_a", "copies_b"])

    return pairs.join(a, "a").join(b, "b").select("a", "b", "copies_a", "copies_b", "toks_a", "toks_b") \
        .mapInArrow(run, "a bigint, b bigint, copies_a bigint, copies_b bigint")


def _overlaps(a: list[np.ndarray], b: list[np.ndarray] | None) -> np.ndarray:
    """How many tokens each of a shares with each of b (none: with each other one of a):
    products of 0/1 matrices over the tokens that occur on both sides, STRIP at a time."""
    flat = [np.concatenate(side) for side in (a, b) if side is not None]
    if b is None:
        tokens = np.sort(flat[0])
        common = np.unique(tokens[1:][tokens[1:] == tokens[:-1]])
    else:
        common = np.intersect1d(*flat)
    at, both = [], np.zeros((len(a), len(a if b is None else b)), np.float32)   # exact: no set has 2^24 tokens of a block
    for side, tokens in zip((a, b), flat):
        row = np.repeat(np.arange(len(side), dtype=np.int32), [len(s) for s in side])
        col = np.searchsorted(common, tokens).astype(np.int32)
        hit = col < len(common)
        hit[hit] = common[col[hit]] == tokens[hit]
        row, col = row[hit], col[hit]
        order = np.argsort(col, kind="stable")
        at.append((row[order], col[order], len(side)))
    for start in range(0, len(common), STRIP):
        width = min(STRIP, len(common) - start)
        strips = []
        for row, col, n in at:
            x, y = np.searchsorted(col, [start, start + width])
            strips.append(np.zeros((n, width), np.float32))
            strips[-1][row[x:y], col[x:y] - start] = 1
        both += strips[0] @ strips[-1].T
    return both


def block_links(sets: list[np.ndarray], side: np.ndarray) -> np.ndarray:
    """Which sets link: all pairs of one block, or only those across two (side has
    0 and 1), of which only the product of one with the other is made."""
    out = np.zeros((len(sets), len(sets)), bool)
    ends = [np.flatnonzero(side == k) for k in (0, 1)]
    if not len(sets) or side.any() and not len(ends[0]):
        return out
    a, b = ends if side.any() else (ends[0], ends[0])
    both = _overlaps([sets[i] for i in a], [sets[i] for i in b] if side.any() else None)
    n = np.array([len(s) for s in sets], np.float64)
    for i, shared_with in zip(a, both):
        out[i, b] = _linked(n[i], n[b], shared_with.astype(np.float64))
    if side.any():
        return out | out.T
    np.fill_diagonal(out, False)
    return out


def _verify_blocks(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, links: edges (links null) of a spanning forest of each pair of blocks, and for each class a how many documents it links with (b null)."""
    ends = pairs.select("x", "y", F.explode(F.when(F.col("x") == F.col("y"), F.array(F.struct(F.col("x").alias("blk"), F.lit(0).alias("side"))))
                                            .otherwise(F.array(F.struct(F.col("x").alias("blk"), F.lit(0).alias("side")), F.struct(F.col("y").alias("blk"), F.lit(1).alias("side"))))).alias("e"))
    rows = ends.select("x", "y", "e.blk", "e.side").join(sets.where("blk is not null"), "blk").select("x", "y", "side", "cls", "copies", "toks")

    def run(t: pa.Table) -> pa.Table:
        _words().clear()   # no text is read here
        t = t.sort_by("cls")
        cls, copies, side = (t[c].to_numpy() for c in ("cls", "copies", "side"))
        link = block_links([_tokens(x) for x in t["toks"].to_pylist()], side)
        counts = np.array([copies[partners].sum() for partners in link])
        edges, todo = [], np.ones(len(cls), bool)
        for root in range(len(cls)):
            if todo[root] and link[root].any():
                reach = np.zeros(len(cls), bool)
                new = np.zeros(len(cls), bool)
                new[root] = True
                while new.any():
                    reach |= new
                    new = link[new].any(0) & ~reach
                todo &= ~reach
                edges += [(cls[root], cls[i]) for i in np.flatnonzero(reach) if i != root]
            todo[root] = False
        some = np.flatnonzero(counts)
        return pa.table({"a": pa.array([*(a for a, _ in edges), *cls[some]], pa.int64()), "b": pa.array([*(b for _, b in edges), *([None] * len(some))], pa.int64()),
                         "links": pa.array([*([None] * len(edges)), *counts[some].astype(np.int64)], pa.int64())})

    return rows.groupBy("x", "y").applyInArrow(run, "a bigint, b bigint, links bigint")


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) of every node of the edges (u, v)."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        near = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else \
            e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        hang = near.join(low, "u").where(F.col("v") > F.col("u") if large else F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not large:
            hang = hang.union(low.select("u", F.col("m").alias("v")))
        return hang.where("u <> v").distinct()

    state, before = stage(edges.select("u", "v").distinct(), "components"), None
    while True:
        state = stage(star(star(state, True), False), "components")
        now = state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).union(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _unconnected(pairs: DataFrame, blocks: DataFrame, edges: DataFrame) -> DataFrame:
    """The pairs (x, y) of blocks whose classes aren't all in one component of the edges (u, v) yet."""
    ends = blocks.join(components(edges).withColumnRenamed("node", "cls"), "cls", "left") \
        .groupBy("blk").agg(F.min(F.coalesce("root", "cls")).alias("lo"), F.max(F.coalesce("root", "cls")).alias("hi"))
    for s in "xy":
        pairs = pairs.join(ends.select(F.col("blk").alias(s), F.col("lo").alias(f"lo_{s}"), F.col("hi").alias(f"hi_{s}")), s)
    return pairs.where("not (lo_x = hi_x and lo_y = hi_y and lo_x = lo_y)").select("x", "y")


def _verify_rounds(pairs: DataFrame, blocks: DataFrame, sets: DataFrame, most: int, name: str) -> DataFrame:
    """_verify_blocks, staged, a round of pairs at a time: each pair sends both of its blocks' sets."""
    size = blocks.groupBy("blk").agg(F.sum("n").alias("s"))
    x, y = (size.select(F.col("blk").alias(k), F.col("s").alias(f"s_{k}")) for k in "xy")
    sent = pairs.join(x, "x").join(y, "y").agg(F.sum(F.col("s_x") + F.when(F.col("x") < F.col("y"), F.col("s_y")).otherwise(0))).first()[0]
    return _in_rounds(_rounds(pairs, ["x", "y"], sent, most), lambda part: _verify_blocks(part, sets), name)


def _compare_blocks(pairs: DataFrame, blocks: DataFrame, sets: DataFrame, light: DataFrame, n_links: bool, most: int) -> DataFrame:
    """As _verify_rounds. Where links needn't be counted, a block is compared with itself and
    the first block it is paired with; of the other pairs only those whose classes are not
    connected by then: a group of m near copies costs some m / BLOCK comparisons, not their square."""
    if n_links:
        return _verify_rounds(pairs, blocks, sets, most, "join-block-links")
    star = stage(pairs.where("x = y").union(pairs.where("x < y").groupBy("y").agg(F.min("x").alias("x")).select("x", "y")), "join-star-pairs")
    first = _verify_rounds(star, blocks, sets, most, "join-star-links")
    known = light.select(F.col("a").alias("u"), F.col("b").alias("v")).union(first.where("b is not null").select("a", "b"))
    rest = stage(_unconnected(pairs.join(star, ["x", "y"], "left_anti"), blocks, known), "join-rest-pairs")
    return first.union(_verify_rounds(rest, blocks, sets, most, "join-block-links"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_links: bool = True) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (the smallest
    doc_id reachable by links) and n_links (documents that it links with; null if not asked for).

    A null text or one without words has an empty set and links with nothing
    (it is its own component). Rows of equal sets link, repeated rows too; a null
    doc_id is smallest only where a component has no other. No rows give none; other columns of docs play no part."""
    docs = docs.selectExpr(f"`{doc_id}` as doc_id", f"`{text}` as text", f"xxhash64(`{text}`) as th")
    members = _members(docs)
    tokens = members.agg(F.sum(F.length("prefix")) / 8).first()[0] or 0
    sizes = stage(members.where("n > 0").groupBy("dig").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("low")), "join-sizes")
    linkable = _linkable(members, _repeated(_prefix_counts(members, 1 + int(tokens) // PART_TOKENS)))
    most = max(ROUND_TOKENS, int(tokens))
    classes = with_row_ids(linkable.join(sizes, "dig"), "join-classes")
    rows = stage(members.select("doc_id", "n", "dig"), "join-rows")
    let_go(members)
    keys = stage(_index(classes), "join-keys")
    known = stage(classes.select(F.col("_uid").alias("cls"), "dig", "low", "copies", "n", F.col("doc_id").alias("_d"), F.col("th").alias("_t")), "join-known")
    let_go(classes)
    lists = stage(keys.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("t")).where("m > 1"), "join-lists")
    repeated = stage(keys.join(lists, "key"), "join-repeated")
    let_go(keys, lists)
    postings = stage(_promising(repeated), "join-postings")
    let_go(repeated)
    blocks, block_pairs = _blocks(postings)
    # A pair that a comparison of blocks covers needs no other.
    ends = [blocks.select(F.col("cls").alias(s), F.col("blk").alias(f"blk_{s}")) for s in "ab"]

    def outside(own: DataFrame) -> DataFrame:
        found = _candidates(own, postings).join(ends[0], "a", "left").join(ends[1], "b", "left") \
            .withColumns({"x": F.least("blk_a", "blk_b"), "y": F.greatest("blk_a", "blk_b"), "_one": F.col("blk_a").isNull() | F.col("blk_b").isNull()})
        return found.join(block_pairs.withColumn("_in", F.lit(True)), ["x", "y"], "left").where(F.col("_one") | F.col("_in").isNull()).select("a", "b", "n")

    met = postings.where(F.col("m") <= RARE).agg(F.sum(F.col("m") - 1)).first()[0] or 0   # twice the pairs; one is sent in the bytes of three tokens or so
    pairs = _in_rounds(_rounds(postings, ["cls"], 3 * met // 2, most), outside, "join-pairs")
    let_go(postings)
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).union(blocks.select("cls")).distinct()
    who = stage(known.join(wanted, "cls").join(blocks.select("cls", "blk"), "cls", "left").select("cls", "copies", "blk", "n", "_d", "_t"), "join-wanted")
    needed, first = who.agg(F.sum("n")).first()[0] or 0, pairs.agg(F.sum("n")).first()[0] or 0
    sets = _in_rounds(_rounds(who, ["cls"], needed, most), lambda part: _fetch(docs, part.drop("n")), "join-sets")
    light = _verify_pairs(pairs.select("a", "b"), sets, 2 * needed + first, most)
    heavy = _compare_blocks(block_pairs, blocks, sets, light, n_links, most)
    edges = light.select(F.col("a").alias("u"), F.col("b").alias("v")).union(heavy.where("b is not null").select("a", "b"))
    links = light.select(F.col("a").alias("cls"), F.col("copies_b").alias("k")).union(light.select("b", "copies_a")) \
        .union(heavy.where("links is not null").select("a", "links")).groupBy("cls").agg(F.sum("k").alias("more"))
    roots = components(edges).withColumnRenamed("node", "cls").join(known.select("cls", "dig", "low"), "cls")
    lowest = roots.groupBy("root").agg(F.min("low").alias("component_id"))
    found = stage(roots.join(lowest, "root").join(links, "cls").select("dig", "component_id", "more"), "join-components")
    by_set = stage(sizes.join(found, "dig", "left").select("dig", F.coalesce("component_id", "low").alias("component_id"),
                                                           (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n_links")), "join-sets-done")
    return rows.join(by_set, "dig", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        (F.coalesce("n_links", F.lit(0)) if n_links else F.lit(None)).cast("long").alias("n_links"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """docs with one row of each component left, that of the smallest doc_id (null
    ids last, then the first row), all columns as they were, whatever their names."""
    names = docs.columns
    own = {c: f"c{i}" for i, c in enumerate(names)}
    with scratch() as kept:
        keyed = with_row_ids(numbered(docs), "near-dedup-docs")
        found = near_duplicates(keyed, doc_id="_uid", text=own["text"], n_links=False).select(F.col("doc_id").alias("_uid"), F.col("component_id").alias("_component"))
        groups = stage(found.join(keyed.select("_uid", F.col(own[doc_id]).alias("_id")), "_uid"), "near-dedup-groups")
        keep = groups.groupBy("_component").agg(F.min(F.struct(F.col("_id").isNull().alias("z"), "_id", "_uid")).alias("k")).select(F.col("k._uid").alias("_uid"))
        # The ids that go are mostly the fewer, and staged: Spark knows their size before it plans the join with the texts.
        copies = stage(groups.select("_uid").join(keep, "_uid", "left_anti"), "near-dedup-copies")
        kept |= {keyed.staged_at, copies.staged_at}
    return keyed.join(copies, "_uid", "left_anti").drop("_uid").toDF(*names)
