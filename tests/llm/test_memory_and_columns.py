"""Bounds that hold across operators: chunk tables of one worker, slices of batches, staged
folders, columns that clash, bands that move smoothly with their group."""

from __future__ import annotations

import os
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from propensia.llm import common, exact_dedup, fertility, ngram_join, queries, vocab

WIDE = "doc_id bigint, text string, _uid string, _key string, c0 int, kept string, _component double, lang string, n_words int"


def wide(spark, texts):
    return spark.createDataFrame([(i, t, f"u{i}", f"k{i}", -i, "yes", i / 2, "en", i) for i, t in enumerate(texts)], WIDE)


def test_tables_in_turn_keep_memory_flat():
    tables = [vocab.ChunkTable(lambda chunks: vocab.runs(chunks, [[len(c), 7] for c in chunks])) for _ in range(4)]
    tracemalloc.start()
    try:
        peaks = []
        for k, table in enumerate(tables):
            for at in range(0, 60_000, 6000):
                table.encode_docs([[f"{k}-chunk-{at + i}" for i in range(6000)]])
            peaks.append(tracemalloc.get_traced_memory()[0])
        assert peaks[0] > 5e6 and max(peaks) < 1.3 * peaks[0]
        assert [len(t.index) for t in tables] == [0, 0, 0, 60_000]
    finally:
        tracemalloc.stop()


def test_table_is_bounded_in_bytes_and_exact():
    """Texts without spaces are one chunk each: the table forgets, its ids stay right."""
    rng = random.Random(3)
    table = vocab.ChunkTable(lambda chunks: vocab.runs(chunks, [list(c.encode()) for c in chunks]), limit=200_000)
    for _ in range(60):
        texts = [["x" * rng.randrange(2000) + str(rng.random())] if rng.random() < 0.5 else ["often", "met", str(rng.randrange(50))] for _ in range(20)]
        assert [i.tolist() for i in table.encode_docs(texts)] == [[b for c in t for b in c.encode()] for t in texts]
        assert table.size < 200_000 + 20 * 3 * 6 * 2020
    assert "often" in table.index


def test_slices_by_rows_and_bytes():
    batch = pa.RecordBatch.from_pydict({"t": ["a" * n for n in (5, 5, 50, 1, 1, 1, 1)] + [None], "n": list(range(8))})
    cut = list(common.slices([batch, batch.slice(0, 0)], rows=3, most=12))
    assert [c.num_rows for c in cut] == [2, 1, 3, 2] and pa.Table.from_batches(cut).equals(pa.Table.from_batches([batch]))


def test_scratch_removes_what_nothing_reads(spark):
    with common.scratch() as keep:
        a, b = (common.stage(spark.range(5), f"scratch-{x}") for x in "ab")
        with common.scratch() as inner:
            c, d = (common.stage(spark.range(5), f"scratch-{x}") for x in "cd")
            inner.add(c.staged_at)
        keep |= {a.staged_at, c.staged_at}
    here = [os.path.exists(x.staged_at.removeprefix("file://")) for x in (a, b, c, d)]
    assert here == [True, False, True, False] and a.count() == 5


def test_dropping_stages_keep_all_values(spark):
    prose = "the quick brown fox jumps over the lazy dog and runs far away into the green hills of the north"
    texts = [prose, prose + " ", " ".join(f"word{i}" for i in range(30)), "###", None, prose + " again", prose.replace(" ", "  ")]
    df = wide(spark, texts)
    rows = {r.doc_id: r for r in df.collect()}
    for out, want in ((exact_dedup.drop_exact_duplicates(df), {6, 2, 3, 4, 5}), (ngram_join.drop_near_duplicates(df), {0, 2, 3, 4}),
                      (fertility.drop_rejected(df, queries.PIECE_MODEL), {0, 1, 2, 5, 6})):
        assert out.schema.names == df.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in df.schema]
        got = out.collect()
        assert {r.doc_id for r in got} == want and all(rows[r.doc_id] == r for r in got)


def noisy(rng, n, noise):
    words = ["house", "garden", "window", "morning", "people", "country", "evening", "letter", "mountain", "together", "summer", "answer"]
    return " ".join("".join(rng.choices("qxzjkvw", k=5)) if rng.random() < noise else rng.choice(words) for _ in range(n))


def test_bands_move_smoothly_with_their_group(spark):
    """The limits of a group have no step at any size: from the script's fixed ones to its own."""
    limits = {}
    for n in (1, 10, 98, 99, 100, 101, 1000):
        rows = [("en", "latin", False, 60, 4.0 + 0.01 * (i % 7), 0.0, 0.9, []) for i in range(n)]
        tries = [1.1 + 2.9 * k / 200 for k in range(201)]   # the lowest that is kept among these is the limit
        probes = [("en", "latin", True, 300, t, 0.0, 0.9, []) for t in tries]   # base_failed: they don't move the bands
        df = spark.createDataFrame(rows + probes, "_lang string, script string, base_failed boolean, n_tokens bigint, chars_per_token double, byte_share double, "
                                                  "entropy_share double, reasons array<string>")
        out = fertility._held_to_corpus(df).where("n_tokens = 300 and size(reasons) = 0")
        limits[n] = out.agg(F.min("chars_per_token")).first()[0]
    sizes = sorted(limits)
    assert [limits[n] for n in sizes] == sorted(limits.values()) and limits[1] < 1.5 and limits[1000] > 3.5
    assert limits[101] - limits[98] < 0.05


@pytest.mark.parametrize("n", [10, 99, 100, 400])
def test_a_noisy_document_among_clean_ones(spark, n):
    rng = random.Random(7)
    texts = [noisy(rng, 120, 0.0) for _ in range(n)] + [noisy(rng, 120, 0.95)]
    out = fertility.quality_measures(wide(spark, texts), queries.PIECE_MODEL).orderBy("doc_id").collect()
    assert all(r.kept for r in out[:-1])
    if n >= 99:
        assert not out[-1].kept


def test_near_duplicate_batches_bounded_by_tokens(spark, monkeypatch):
    """Many batches and ranges give the same groups as one."""
    rng = np.random.default_rng(8)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 400, 80)) for _ in range(40)]
    texts = base + [t.replace(t.split()[40], "other", 1) for t in base] + base[:5]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    want = sorted(map(tuple, ngram_join.near_duplicates(df).collect()))
    monkeypatch.setattr(ngram_join, "BATCH_TOKENS", 60)
    monkeypatch.setattr(ngram_join, "PART_TOKENS", 100)
    assert sorted(map(tuple, ngram_join.near_duplicates(df).collect())) == want
    assert len({r[2] for r in want}) == 40


def test_block_comparison_equals_all_pairs():
    """Sets of one block and across two, some empty or with nothing in common, against every pair's intersection."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 120).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.permutation(120)[:int(rng.integers(100, 120))]], rng.integers(0, 1 << 62, 3).astype(np.uint64)])) for _ in range(50)]
    sets += [np.empty(0, np.uint64), rng.integers(0, 1 << 62, 9).astype(np.uint64)]
    for side in (np.zeros(52, int), (np.arange(52) % 3 == 0).astype(int), np.ones(52, int)):
        want = [[i != j and len(both := np.intersect1d(x, y)) > 0 and 100 * len(both) >= 85 * len(np.union1d(x, y)) and (not side.any() or side[i] != side[j])
                 for j, y in enumerate(sets)] for i, x in enumerate(sets)]
        assert ngram_join.block_links(sets, side).tolist() == want
    assert ngram_join.block_links([], np.zeros(0, int)).shape == (0, 0)
