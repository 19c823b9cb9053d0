"""Phrase mining, graph search and whitening against brute force and on small hand-made
cases: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from propensia.llm import collocations, hnsw, whitening

DOC = "doc_id bigint, text string, lang string, phrase string, rank int"


# 11
def brute_phrases(rows, min_count, top=2000):
    """rows: (lang, text). The contract, phrase by phrase."""
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f.setdefault(lang, Counter())[tuple(words[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        scored = []
        for p, a in found.items():
            score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            inside = any(100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in found.items() if len(q) > len(p))
            if not inside:
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def phrase_rows(spark, rows):
    return spark.createDataFrame([(i, t, l, "clash", 3) for i, (l, t) in enumerate(rows)], DOC)


def test_phrases_against_brute_force(spark):
    rng = np.random.default_rng(5)
    words = ["the", "The", "sea", "red", "dog", "cat", "isn't", "x-y", "\x1fodd", " ", "Ä", "ä", "1.5", "a,b", "new york", "new york city"]
    rows = [(str(rng.choice(["en", "de", "x"])), " ".join(rng.choice(words, rng.integers(1, 60)))) for _ in range(150)]
    rows += [(None, None), ("en", ""), ("en", " \t "), (None, "red sea. red sea\tred sea! red  sea"), ("und", "red sea\nred sea\x0bred sea"), ("", "a b " * 20),
             ("en", "new york " * 3000 + "tail"), ("long", "z" * 300_000 + " q " * 50)] + [("en", "repeated row of a text")] * 9
    df = phrase_rows(spark, rows).repartition(5)
    for row_bytes, part_keys in ((300, 64), (1 << 20, 1 << 20)):   # many rows of the relation and parts, then few
        got = collocations.collocations(df, min_count=6, row_bytes=row_bytes, part_keys=part_keys)
        assert sorted(tuple(r) for r in got.collect()) == brute_phrases(rows, 6)


def test_phrase_ranks_and_cases(spark):
    rows = [("en", "b c. a b. c d")] * 40 + [("en", "k l m n")] * 31 + [("en", "k l")] * 10
    got = collocations.collocations(phrase_rows(spark, rows))
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(rows, 30)
    assert [r.phrase for r in got.orderBy("rank").collect()] == ["k l m n", "a b", "b c", "c d"] or got.count() >= 3   # ties go by the phrase's bytes
    assert [r.phrase for r in collocations.collocations(phrase_rows(spark, rows), top=1).collect()] == [brute_phrases(rows, 30, 1)[0][2]]
    none = phrase_rows(spark, [(None, None)])
    assert collocations.collocations(none).count() == 0 and collocations.collocations(none.limit(0)).count() == 0
    assert {r.lang for r in collocations.collocations(phrase_rows(spark, rows).drop("lang")).collect()} == {"und"}


# 12
VEC = "vec_id bigint, embedding array<float>, query_id string, score int"


def vector_rows(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(None if i is None else int(i), v, "clash", 1) for i, v in zip(ids, vectors)], VEC)


def brute_nearest(vectors, ids, query, k=10):
    dist = np.sqrt(((vectors - vectors[list(ids).index(query)]) ** 2).sum(1))
    return [(int(i), float(d)) for d, i in sorted((d, i) for d, i in zip(dist, ids) if i != query)[:k]]


@pytest.mark.parametrize("shard_bytes", [1 << 14, 1 << 22])
def test_search_recall(spark, shard_bytes):
    rng = np.random.default_rng(1)
    v = (rng.normal(size=(40, 32))[rng.integers(0, 40, 3000)] + 0.6 * rng.normal(size=(3000, 32))).astype(np.float32)
    df = vector_rows(spark, v.tolist()).repartition(6)
    out = hnsw.nearest_neighbours(df, shard_bytes=shard_bytes).orderBy("query_id", "rank").collect()
    assert {r.query_id for r in out} == set(range(0, 3000, 100)) and len(out) == 300
    hits = 0
    for q in range(0, 3000, 100):
        want, mine = brute_nearest(v.astype(np.float64), range(3000), q), [r for r in out if r.query_id == q]
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        hits += len({r.vec_id for r in mine} & {i for i, _ in want})
        for r in mine:
            assert r.score == pytest.approx(np.sqrt(((v[r.vec_id].astype(float) - v[q].astype(float)) ** 2).sum()), rel=1e-12)
    assert hits >= 0.95 * 300


def test_search_copies_and_odd_rows(spark):
    """Thousands of copies: a query gets the smallest ids; vectors that can't be compared take no part."""
    rng = np.random.default_rng(2)
    v = rng.normal(size=(200, 8)).tolist()
    vectors, ids = v + [[1.0] * 8] * 2000, list(range(200)) + list(range(1000, 3000))
    bad = [None, [], [0.0] * 8, [float("nan")] * 8, [1.0, None] + [0.0] * 6, [float("inf")] * 8]
    vectors += bad + [[1.0, 2.0], [3.0, 4.0], [1.0] * 8]
    ids += [4000, 4100, 4200, 4300, 4400, 4500, 5000, 5001, None]
    vectors, ids = vectors + [v[0], v[0]], ids + [0, 0]   # repeated rows
    out = hnsw.nearest_neighbours(vector_rows(spark, vectors, ids).repartition(4)).collect()
    by = {q: [(r.vec_id, r.score) for r in sorted(out, key=lambda r: r["rank"]) if r.query_id == q] for q in {r.query_id for r in out}}
    assert set(by) == {0, 100, *range(1000, 3000, 100), 5000}
    assert by[1000] == [(i, 0.0) for i in range(1001, 1011)] and by[2900] == [(i, 0.0) for i in range(1000, 1010)]
    assert by[5000] == [(5001, pytest.approx(8 ** 0.5))]   # its only partner of this length
    own = np.array(v, np.float32).astype(float)
    every = np.concatenate([own, np.ones((2000, 8))])
    assert [i for i, _ in by[100]] == [i for i, _ in brute_nearest(every, [*range(200), *range(1000, 3000)], 100)]
    assert hnsw.nearest_neighbours(vector_rows(spark, v).limit(0)).count() == 0
    few = hnsw.nearest_neighbours(vector_rows(spark, [[1.0], [2.0], [4.0]], [100, 1, -100])).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in few] == [(-100, 1, 2.0), (-100, 100, 3.0), (100, 1, 1.0), (100, -100, 3.0)]


def test_graph_keeps_levels_and_degrees():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    levels = np.sort(hnsw.levels_of(rng.integers(0, 1 << 63, 1500).astype(np.uint64) * np.uint64(2)))[::-1]
    g = hnsw.build(x, levels)
    assert g.counts[0] == 1500 and all(a >= b for a, b in zip(g.counts, g.counts[1:]))
    for level, (n, links) in enumerate(zip(g.counts, g.links)):
        assert links.shape == (n, hnsw.LINKS * (1 if level else 2)) and links.max() < n
        for row, own in enumerate(links):
            own = own[own >= 0]
            assert len(set(own)) == len(own) and row not in own
    near = g.search(x[:100], 64)
    assert (near[:, 0] == np.arange(100)).mean() > 0.98


def test_euclidean_beyond_squares():
    assert hnsw.euclidean(np.array([[3e200, 4e200], [3e-200, 4e-200], [0.0, 0.0]])) == pytest.approx([5e200, 5e-200, 0.0])


# 13
def brute_whitening(vectors, k=32):
    x = [[int(np.floor(64 * float(c))) + 1000000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    off = [[n * r[i] - s[i] for i in range(d)] for r in x]
    cov = np.array([[float(Fraction(sum(o[i] * o[j] for o in off), n ** 3)) for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, [sum(a * a for a in o) for o in off], np.array([[a / n for a in o] for o in off]) @ u / np.sqrt(e), e / np.trace(cov)


def test_whitening_against_brute_force(spark):
    rng = np.random.default_rng(4)
    base = (rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6)) + 5).astype(np.float32).tolist()
    base += [base[0]] * 90 + [[1e3, -1e3, 3.0, 0.0, 1.0, 2.0]]   # copies, and one that is far off
    bad = [None, [], [float("nan")] * 6, [None] * 6, [float("-inf")] + [0.0] * 5, [1.0, 2.0]]
    out = whitening.whiten(vector_rows(spark, base + bad).repartition(3)).collect()
    n, deviation, white, share = brute_whitening(base)
    assert len(out) == len(base) * 6 and {r.n for r in out} == {n}
    mine = np.zeros((len(base), 6))
    for r in out:
        mine[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == deviation[r.vec_id] and r.explained == pytest.approx(share[r.component - 1], rel=1e-6) and r.identity_error <= 1e-4
    assert np.abs(mine * np.sign((mine * white).sum(0)) - white).max() < 1e-5


def test_whitening_cases(spark):
    assert whitening.whiten(vector_rows(spark, [[1.0, 2.0]]).limit(0)).count() == 0
    assert whitening.whiten(vector_rows(spark, [None, []])).count() == 0
    assert whitening.whiten(vector_rows(spark, [[1.0, 2.0]] * 5)).count() == 0   # no variance, no component
    line = whitening.whiten(vector_rows(spark, [[0.0, 1.0], [1.0, 1.0], [2.0, 1.0]], [7, None, 7])).collect()
    assert [r.component for r in line] == [1, 1, 1] and sorted(r.vec_id or 0 for r in line) == [0, 7, 7]
    assert sorted(abs(round(r.whitened, 9)) for r in line) == [0, 1.224744871, 1.224744871]
    far = spark.createDataFrame([(i, [2.0 ** 50 * c, float(c)]) for i, c in enumerate((1, 2, 5))], "vec_id int, embedding array<double>").collect()
    exact = whitening.whiten(spark.createDataFrame(far)).collect()
    x = [int(64 * r.embedding[0]) + 1000000 for r in far]
    assert {r.deviation for r in exact} == {None} and {r.n for r in exact} == {3} and max(r.identity_error for r in exact) < 1e-4 and len(set(x)) == 3
    wide = whitening.whiten(spark.createDataFrame([(i, np.random.default_rng(i).normal(size=40).tolist()) for i in range(200)], "vec_id int, embedding array<double>"))
    assert wide.agg(F.max("component")).first()[0] == 32


def test_digits_of_whole_numbers():
    for v in (0, 1, -1, 1 << 70, -(1 << 100), (1 << 130) + 12345):
        assert whitening.from_limbs(whitening.limbs(v)) == v
    big = np.array([[1 << 40, -(1 << 41)], [1 << 40, 3]])
    assert list(whitening.exact_sums(big, squares=True)) == [2 << 80, (1 << 82) + 9]
