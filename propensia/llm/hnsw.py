"""Approximate nearest neighbours by a hierarchical small-world graph per shard.

Equal vectors are one node with the smallest ids of its rows, so thousands of copies
neither fill a graph nor a result. The nodes, spread by a hash of the vector, are taken
in shards of bounded size; each shard's graph is built by insertion: a node's level is
drawn from its hash, beams from the top level down find its neighbours, a pruning for
diversity picks the links, and both ends keep at most ``LINKS`` of them (twice as many
on the ground level). A graph is stored as one row of flat arrays (vectors, ids, and
for each level the members and their neighbours), so a search only reads it.

Queries travel in blocks; every block meets every shard, and the hits of all shards are
merged by exact distance. Nodes and queries are handled in numpy many at a time: one
step of a beam expands the best open node of every query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stage
from .vectors import finite_vectors

NEAREST = 10
LINKS = 16            # of a node above the ground level; twice as many on it
BUILD_BEAM, SEARCH_BEAM = 80, 128
TOGETHER = 256        # nodes or queries in one numpy step
SHARD_BYTES = 8 << 20     # vectors of one shard, as doubles
QUERY_BYTES = 2 << 20     # vectors of one block of queries
SALTS = 32
FAR = np.float32(np.inf)


def _distances(x: np.ndarray, ids: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances of q's rows from the nodes of ids' rows; -1 is no node."""
    diff = x[ids]
    diff -= q[:, None, :]
    out = np.einsum("bkd,bkd->bk", diff, diff)
    out[ids < 0] = FAR
    return out


def _best(ids: np.ndarray, dist: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest of each row in order, filled up with -1."""
    if ids.shape[1] > k:
        at = np.argpartition(dist, k - 1, axis=1)[:, :k]
        ids, dist = np.take_along_axis(ids, at, 1), np.take_along_axis(dist, at, 1)
    at = np.lexsort((ids, dist), axis=1)
    ids, dist = np.take_along_axis(ids, at, 1), np.take_along_axis(dist, at, 1)
    return np.where(np.isinf(dist), -1, ids), dist


def beam(x: np.ndarray, links: np.ndarray, q: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of q the nodes (at most width, nearest first) that a beam from start's
    row finds, and their squared distances. Ends when every node of every beam is expanded."""
    b = len(q)
    seen = np.zeros((b, len(x) + 1), bool)   # the last column takes the -1
    seen[:, -1] = True
    ids = np.full((b, width), -1, np.int64)
    dist = np.full((b, width), FAR, np.float32)
    k = min(width, start.shape[1])
    found, far = _best(start, _distances(x, start, q), k)
    ids[:, :k], dist[:, :k] = found, far
    np.put_along_axis(seen, ids, True, 1)
    todo = ids >= 0
    rows = np.arange(b)
    while len(rows):
        open_ = np.where(todo[rows], dist[rows], FAR)
        at = open_.argmin(1)
        live = np.isfinite(open_[np.arange(len(rows)), at])
        rows, at = rows[live], at[live]
        if not len(rows):
            break
        todo[rows, at] = False
        near = links[ids[rows, at]]
        near = np.where(seen[rows[:, None], near], -1, near)
        seen[rows[:, None], near] = True
        away = _distances(x, near, q[rows])
        better = away < dist[rows].max(1)[:, None]
        near, away = np.where(better, near, -1), np.where(better, away, FAR)
        some = better.any(1)
        r = rows[some]
        all_ids, all_dist = np.concatenate([ids[r], near[some]], 1), np.concatenate([dist[r], away[some]], 1)
        all_todo = np.concatenate([todo[r], near[some] >= 0], 1)
        keep = np.argpartition(all_dist, width - 1, axis=1)[:, :width]
        ids[r], dist[r], todo[r] = (np.take_along_axis(a, keep, 1) for a in (all_ids, all_dist, all_todo))
    return _best(ids, dist, width)


def diverse(x: np.ndarray, ids: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates (nearest first) those nearer to the row's own node than to
    any one picked before, at most ``most``; places left over go to the nearest others."""
    b, c = ids.shape
    v = x[ids]
    norm = np.einsum("bcd,bcd->bc", v, v)
    between = norm[:, :, None] + norm[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
    picked = np.zeros((b, c), bool)
    close = np.full((b, c), FAR, np.float32)   # distance from the nearest picked one
    for k in range(c):
        ok = (ids[:, k] >= 0) & (dist[:, k] < close[:, k]) & (picked.sum(1) < most)
        picked[:, k] = ok
        close[ok] = np.minimum(close[ok], between[ok, k])
    order = np.argsort(np.where(ids < 0, 2, np.where(picked, 0, 1)), axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(ids, order, 1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


def _link_back(x: np.ndarray, links: np.ndarray, new: np.ndarray, picked: np.ndarray) -> None:
    """Add the new nodes to the lists of those that they picked; overfull lists are pruned."""
    most = links.shape[1]
    src, dst = np.repeat(new, picked.shape[1]), picked.ravel()
    src, dst = src[dst >= 0], dst[dst >= 0]
    gap = x[src] - x[dst]
    away = np.einsum("kd,kd->k", gap, gap)
    order = np.lexsort((src, away, dst))
    src, dst = src[order], dst[order]
    node, first = np.unique(dst, return_index=True)
    place = np.arange(len(dst)) - np.repeat(first, np.diff([*first, len(dst)]))
    src, dst, place = src[place < most], dst[place < most], place[place < most]
    more = np.full((len(node), most), -1, np.int64)
    more[np.searchsorted(node, dst), place] = src
    more[(more[:, :, None] == links[node][:, None, :]).any(2)] = -1   # two new nodes that picked each other
    free = (links[node] < 0).sum(1)
    for at in range(0, len(node), TOGETHER):
        own, add = node[at:at + TOGETHER], more[at:at + TOGETHER]
        both = np.concatenate([links[own], add], 1)
        order = np.argsort(both < 0, axis=1, kind="stable")
        both = np.take_along_axis(both, order, 1)
        fits = (add >= 0).sum(1) <= free[at:at + TOGETHER]
        links[own[fits]] = both[fits, :most]
        if not fits.all():
            ids, dist = _best(both[~fits], _distances(x, both[~fits], x[own[~fits]]), both.shape[1])
            links[own[~fits]] = diverse(x, ids, dist, most)


def levels_of(keys: np.ndarray) -> np.ndarray:
    """A node's highest level: each further one for a share 1 / LINKS of the nodes."""
    u = (keys.astype(np.float64) + 0.5) / 2.0 ** 64
    return np.minimum(-np.log(u) / np.log(LINKS), 12).astype(np.int64)


@dataclass
class Graph:
    """x: search vectors of the nodes, those of the highest levels first, so that the
    members of a level are the first counts[level] nodes; links[level]: their neighbours (-1: none)."""

    x: np.ndarray
    counts: list[int]
    links: list[np.ndarray]

    def entries(self, q: np.ndarray, level: int, inserted: int) -> np.ndarray:
        """Where beams of a level start: what beams through the levels above it find, or its first node."""
        found = np.zeros((len(q), 1), np.int64)
        for upper in range(len(self.counts) - 1, level, -1):
            found, _ = beam(self.x[:self.counts[upper]], self.links[upper], q, found, 4)
        found = np.where(found < inserted, found, -1)
        found[(found < 0).all(1), 0] = 0
        return found

    def search(self, q: np.ndarray, width: int) -> np.ndarray:
        """Of each row of q about the nearest ``width`` nodes, nearest first; -1 where there are fewer."""
        parts = [q[at:at + TOGETHER] for at in range(0, len(q), TOGETHER)]
        return np.concatenate([beam(self.x, self.links[0], p, self.entries(p, 0, len(self.x)), width)[0] for p in parts])


def build(x: np.ndarray, levels: np.ndarray) -> Graph:
    """The graph of the rows of x, whose levels must descend."""
    top = int(levels.max(initial=0))
    counts = [int((levels >= l).sum()) for l in range(top + 1)]
    graph = Graph(x, counts, [np.full((n, 2 * LINKS if l == 0 else LINKS), -1, np.int64) for l, n in enumerate(counts)])
    for level in range(top, -1, -1):
        links, step = graph.links[level], 0
        while step < counts[level]:
            size = min(TOGETHER, counts[level] - step, max(step, LINKS))
            new = np.arange(step, step + size)
            q = x[new]
            dist = _distances(x, np.broadcast_to(new, (size, size)), q)
            np.fill_diagonal(dist, FAR)   # nodes inserted together see each other, not themselves
            ids = np.where(np.isinf(dist), -1, new)
            if step:
                near, away = beam(x[:step], links[:step], q, graph.entries(q, level, step), BUILD_BEAM)
                ids, dist = np.concatenate([near, ids], 1), np.concatenate([away, dist], 1)
            ids, dist = _best(ids, dist, min(BUILD_BEAM, ids.shape[1]))
            picked = diverse(x, ids, dist, LINKS)
            links[new, :LINKS] = picked
            _link_back(x, links, new, picked)
            step += size
    return graph


def search_vectors(vectors: np.ndarray, scale: float, centre: np.ndarray) -> np.ndarray:
    """Scaled, centred and rounded: beams only steer by them."""
    return (np.clip(vectors / scale, -1e15, 1e15) - centre).astype(np.float32)


def euclidean(diff: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        plain = np.sqrt(np.einsum("...d,...d->...", diff, diff))
        top = np.abs(diff).max(-1)
        part = diff / np.where(top > 0, top, 1)[..., None]
        return np.where(np.isfinite(plain) & ((plain > 1e-140) | (top == 0)), plain, top * np.sqrt(np.einsum("...d,...d->...", part, part)))


def usable(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, vec (doubles): one row for each id that isn't null, of a vector that is neither null, empty nor zero and
    has only finite entries; of several such vectors of one id the smallest, entry by entry."""
    rows = df.select(df[vec_id].cast("long").alias("id"), df[vector].cast("array<double>").alias("vec"))
    return rows.where("id is not null and size(vec) > 0 and forall(vec, x -> x is not null and abs(x) < double('Infinity')) and exists(vec, x -> x <> 0)") \
        .groupBy("id").agg(F.min("vec").alias("vec"))


def _nodes(rows: DataFrame, nearest: int) -> DataFrame:
    """vec, ids: the distinct vectors and the smallest ids of their rows, as many as a result can name.
    Ids are first taken apart by a salt, so that a vector of a third of all rows is no hot group."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    few = salted.withColumn("k", F.row_number().over(Window.partitionBy("vec", "salt").orderBy("id"))).where(F.col("k") <= nearest + 1)
    return few.groupBy("vec").agg(F.slice(F.sort_array(F.collect_list("id")), 1, nearest + 1).alias("ids"))


def build_index(nodes: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard, staged: shard, dim, vectors (doubles), ids and id_counts of each node, counts and links of the levels."""
    def row(shard: int, dim: int, vectors: np.ndarray, ids: list[list[int]]) -> dict:
        keys = np.array([xxhash.xxh64_intdigest(v.tobytes()) for v in vectors], np.uint64)
        levels = levels_of(keys)
        order = np.lexsort((keys, -levels))
        vectors, ids = vectors[order], [ids[i] for i in order]
        scale, centre = _frame(vectors)
        graph = build(search_vectors(vectors, scale, centre), levels[order])
        return {"shard": shard, "dim": dim, "vectors": vectors.tobytes(), "ids": np.array([i for x in ids for i in x], np.int64).tobytes(),
                "id_counts": np.array([len(x) for x in ids], np.int32).tobytes(), "counts": np.array(graph.counts, np.int32).tobytes(),
                "links": b"".join(k.astype(np.int32).tobytes() for k in graph.links)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        task, made = TaskContext.get().partitionId() << 32, 0
        for batch in slices(batches):
            all_ids = batch.column("ids").to_pylist()
            for rows, matrix in finite_vectors(batch.column("vec")):
                dim = matrix.shape[1]
                vectors, ids = held.setdefault(dim, ([], []))
                vectors.append(matrix)
                ids += [all_ids[i] for i in rows]
                if len(ids) * dim * 8 >= shard_bytes:
                    yield pa.RecordBatch.from_pylist([row(task + made, dim, np.concatenate(vectors), ids)], schema=kinds)
                    made += 1
                    del held[dim]
        for dim, (vectors, ids) in sorted(held.items()):
            yield pa.RecordBatch.from_pylist([row(task + made, dim, np.concatenate(vectors), ids)], schema=kinds)
            made += 1

    kinds = pa.schema([("shard", pa.int64()), ("dim", pa.int32()), *((c, pa.binary()) for c in ("vectors", "ids", "id_counts", "counts", "links"))])
    return stage(nodes.mapInArrow(run, "shard bigint, dim int, vectors binary, ids binary, id_counts binary, counts binary, links binary"), "ann-index")


def _frame(vectors: np.ndarray) -> tuple[float, np.ndarray]:
    scale = float(np.abs(vectors).max()) or 1.0
    return scale, (vectors / scale).mean(0)


def query_blocks(queries: DataFrame, block_bytes: int = QUERY_BYTES) -> DataFrame:
    """block, dim, ids, vectors: id and vec of the queries, many to a row; staged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        task, made = TaskContext.get().partitionId() << 32, 0
        for batch in slices(batches):
            all_ids = batch.column("id").to_numpy(zero_copy_only=False)
            for rows, matrix in finite_vectors(batch.column("vec")):
                if len(rows):
                    held.setdefault(matrix.shape[1], []).append((all_ids[rows], matrix))
            for dim in [d for d, parts in held.items() if sum(len(i) for i, _ in parts) * d * 8 >= block_bytes]:
                yield block(task + made, dim, held.pop(dim))
                made += 1
        for dim, parts in sorted(held.items()):
            yield block(task + made, dim, parts)
            made += 1

    def block(number: int, dim: int, parts: list) -> pa.RecordBatch:
        ids, vectors = (np.concatenate(c) for c in zip(*parts))
        return pa.RecordBatch.from_pydict({"block": pa.array([number]), "dim": pa.array([dim], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary()),
                                           "vectors": pa.array([vectors.tobytes()], pa.binary())})

    # dealt anew by size, so that blocks are as few and full as can be
    return stage(queries.select("id", "vec").hint("rebalance").mapInArrow(run, "block bigint, dim int, ids binary, vectors binary"), "ann-queries")


def search_index(index: DataFrame, blocks: DataFrame, nearest: int = NEAREST, width: int = SEARCH_BEAM) -> DataFrame:
    """query_id, vec_id, score: of each query and shard the nearest found. Every block of queries meets every shard of its dimension."""
    def run(shards: pa.Table, queries: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if shards.num_rows and queries.num_rows:
            s, q = shards.to_pylist()[0], queries.to_pylist()[0]
            v = np.frombuffer(s["vectors"]).reshape(-1, s["dim"])
            counts, flat, at, links = np.frombuffer(s["counts"], np.int32).tolist(), np.frombuffer(s["links"], np.int32), 0, []
            for level, n in enumerate(counts):
                size = n * LINKS * (1 if level else 2)
                links.append(flat[at:at + size].reshape(n, -1).astype(np.int64))
                at += size
            scale, centre = _frame(v)
            ask, own = np.frombuffer(q["vectors"]).reshape(-1, s["dim"]), np.frombuffer(q["ids"], np.int64)
            found = Graph(search_vectors(v, scale, centre), counts, links).search(search_vectors(ask, scale, centre), width)
            row, place = np.nonzero(found >= 0)
            node = found[row, place]
            score = np.concatenate([np.zeros(0), *(euclidean(v[node[k:k + 4096]] - ask[row[k:k + 4096]]) for k in range(0, len(node), 4096))])
            n_ids = np.frombuffer(s["id_counts"], np.int32).astype(np.int64)
            first, ids = np.cumsum(n_ids) - n_ids, np.frombuffer(s["ids"], np.int64)
            many = n_ids[node]
            vec = ids[np.repeat(first[node], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
            row, score = np.repeat(row, many), np.repeat(score, many)
            other = vec != own[row]
            row, vec, score = row[other], vec[other], score[other]
            order = np.lexsort((vec, score, row))
            row, vec, score = row[order], vec[order], score[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            out = [own[row], vec, score]
            out = [c[rank < nearest] for c in out]
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    pairs = index.select("dim", "shard").join(blocks.select("dim", "block"), "dim").select("shard", "block")
    left, right = index.join(pairs, "shard"), blocks.join(pairs, "block")
    right = right.select(F.col("shard").alias("by_shard"), F.col("block").alias("by_block"), "dim", "ids", "vectors")
    return left.groupBy("shard", "block").cogroup(right.groupBy("by_shard", "by_block")) \
        .applyInArrow(run, "query_id bigint, vec_id bigint, score double")


def nearest_neighbours(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", nearest: int = NEAREST, every: int = 100, width: int = SEARCH_BEAM,
                       shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by ``every`` the
    nearest other rows found, by Euclidean distance of the original vectors in doubles, ties
    to the smaller id; all of them if there are fewer.

    Null ids, and vectors that are null, empty, zero or hold a null or non-finite entry,
    take no part. Rows of one id are one row (that of the smallest vector). Vectors meet
    those of equal length only. Equal vectors of different ids are all found, at distance 0 from
    each other. An empty table gives no rows; other columns play no part."""
    rows = stage(usable(df, vec_id, vector), "ann-rows")
    index = build_index(_nodes(rows, nearest), shard_bytes)
    hits = search_index(index, query_blocks(rows.where(F.pmod("id", F.lit(every)) == 0)), nearest, width)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")
