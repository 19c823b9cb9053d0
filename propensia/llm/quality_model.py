"""Quality classifier by ordinal cumulative-link regression.

Ratings are ordered grades: 0 poor, 1 well written but toxic, 2 clean. One
weight vector over hashed text features gives a score s; ordered thresholds
t1 <= t2 turn it into P(grade >= k) = sigmoid(s - tk). Selection goes by the
tail probability P(grade >= 2); the expected grade is the sum of both tails.

Features: each distinct word (lower case, without punctuation around it) and,
by its share of the words, each word shape (``Word,`` is ``Xx,``); each first four
letters that two or more of its words share, so that words vary in form on one stem
and still count; repeated words and lines by their share. Weights are fitted with an L1 penalty, so a word
that says nothing has weight 0 and long texts aren't at a disadvantage.

The fit uses at most ``max_labels`` labelled documents, those of the smallest
hashes of doc_id; scoring covers every document. The least tail probability of a
kept document is chosen on all of them by cross-validation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .vocab import ChunkTable, runs

BITS = 18
MAX_LABELS = 12_000
#: The least tail before any clean document has been seen, and how many of them it weighs as much as.
MIN_TAIL, TAIL_WEIGHT = 0.5, 500
#: Parts that are held out in turn, and the share of clean documents, each judged by the fit without its part, that stays.
FOLDS, CLEAN_KEPT = 3, 0.998
STEM = 4

#: Places after the hashed ones: share of words equal to the one before, share
#: of repeated lines, share of distinct words, and 1.
EXTRA = 4
DIM = (1 << BITS) + EXTRA

_CLASSES = ((re.compile(r"[A-ZÀ-ÖØ-Þ]+"), "X"), (re.compile(r"[a-zß-öø-ÿ]+"), "x"), (re.compile(r"\d+"), "9"), (re.compile(r"([^\w\s])\1+"), r"\1\1"))


def word_features(chunk: str) -> tuple[int, int, int]:
    """Places of the chunk's word, of its shape and of its stem; shapes share no place's low bit with the others."""
    shape = chunk
    for pattern, sign in _CLASSES:
        shape = pattern.sub(sign, shape)
    half = (1 << BITS) - 1
    word = chunk.strip(".,!?;:*#$%&|()[]{}<>-_=+/\\\"'~^@").lower()
    return (xxhash.xxh32_intdigest(word) & half & ~1, xxhash.xxh32_intdigest(shape[:8], seed=1) & half | 1,
            xxhash.xxh32_intdigest(word[:STEM], seed=2) & half & ~1)


@lru_cache(maxsize=1)
def _features_of_chunks() -> ChunkTable:
    return ChunkTable(lambda chunks: runs(chunks, [word_features(c) for c in chunks]))


def text_features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text the places of its features and their values."""
    table, words = _features_of_chunks(), [t.split() for t in texts]
    out = []
    for text, ids in zip(texts, table.encode_docs(words)):
        word, shape, stem = ids[0::3], ids[1::3], ids[2::3]
        n = max(len(word), 1)
        own, first = np.unique(word, return_index=True)
        stems, words_of = np.unique(stem[first], return_counts=True)
        stems = stems[words_of > 1]
        kind, count = np.unique(shape, return_counts=True)
        lines = [x for x in text.split("\n") if x.strip()]
        extra = [float((word[1:] == word[:-1]).sum()) / n, 1 - len(set(lines)) / max(len(lines), 1), len(own) / n, 1.0]
        out.append((np.concatenate([own, kind, stems, np.arange(DIM - EXTRA, DIM)]).astype(np.int32),
                    np.concatenate([np.ones(len(own)), np.sqrt(count / n), np.ones(len(stems)), extra]).astype(np.float32)))
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray      # DIM
    thresholds: np.ndarray   # ascending, one for each grade above 0
    min_tail: float = MIN_TAIL

    def tails(self, features: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ...; one row for each text."""
        score = np.array([float(self.weights[i] @ v) for i, v in features])
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def fit_ordinal(features: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int = 3, l1: float = 2e-4,
                rounds: int = 150) -> OrdinalModel:
    """Accelerated proximal gradient on the mean negative log likelihood. The
    thresholds are t1 and t1 plus positive steps, which keeps them in order.
    Without rows every text gets the top grade."""
    if not len(grades):
        return OrdinalModel(np.zeros(DIM, np.float32), np.linspace(-40, -39, n_grades - 1))
    sizes = np.fromiter((len(i) for i, _ in features), np.int64, len(features))
    starts = np.cumsum(sizes) - sizes
    place, value = np.concatenate([i for i, _ in features]), np.concatenate([v for _, v in features]).astype(np.float64)
    row = np.repeat(np.arange(len(grades)), sizes)
    share = np.bincount(grades, minlength=n_grades) / len(grades)
    above = np.clip(1 - np.cumsum(share)[:-1], 0.01, 0.99)
    cut = -np.log(above / (1 - above))
    theta = np.concatenate([cut[:1], np.log(np.maximum(np.diff(cut), 0.1))])
    # A place's own step: the second derivative is at most a quarter of the mean of its squared values, times a text's weight.
    curve = np.bincount(place, value ** 2, DIM) / len(grades)
    step = 1 / (0.25 * np.sqrt(np.maximum(curve, 1e-12) * (value ** 2).sum() / len(grades)) + 1e-6)
    w = seen = np.zeros(DIM)
    momentum = 1.0
    for _ in range(rounds):
        t = theta[0] + np.concatenate([[0.0], np.cumsum(np.exp(theta[1:]))])
        s = np.add.reduceat(seen[place] * value, starts)
        edges = np.concatenate([[-np.inf], t, [np.inf]])
        a, b = s - edges[grades], s - edges[grades + 1]
        pa_, pb = _sigmoid(np.where(np.isinf(a), 40, a)), _sigmoid(np.where(np.isinf(b), -40, b))
        gap = np.maximum(pa_ - pb, 1e-9)
        slope = -(1 - pa_ - pb) / len(grades)
        new = seen - step * np.bincount(place, slope[row] * value, DIM)
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
        da, db = pa_ * (1 - pa_) / gap, pb * (1 - pb) / gap
        by_cut = np.array([(da[grades == k].sum() - db[grades == k - 1].sum()) / len(grades) for k in range(1, n_grades)])
        grad = np.array([by_cut.sum(), *(by_cut[k:].sum() * np.exp(theta[k]) for k in range(1, n_grades - 1))])
        theta = theta - 1.0 * grad
        after = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        seen, w, momentum = new + (momentum - 1) / after * (new - w), new, after
    return OrdinalModel(w.astype(np.float32), theta[0] + np.concatenate([[0.0], np.cumsum(np.exp(theta[1:]))]))


def grade(quality, toxic):
    return F.when(quality == 1, F.when(toxic == 1, F.lit(1)).otherwise(F.lit(2))).otherwise(F.lit(0))


def labelled_features(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> list[tuple[int, tuple[np.ndarray, np.ndarray]]]:
    """(grade, features) of at most max_labels rated documents. Labels without
    doc_id or quality are no ratings; of several ratings the lowest counts; of
    repeated documents the row of the smallest text hash counts."""
    rated = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()) \
        .groupBy("doc_id").agg(F.min(grade(F.col("quality"), F.col("toxic"))).alias("grade"))
    rated = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)
    joined = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(rated), "doc_id")   # max_labels bounds its size
    joined = joined.groupBy("doc_id", "grade").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("_row")) \
        .select("doc_id", "grade", F.col("_row.text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = text_features([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("grade"), pa.array([i.tobytes() for i, _ in found], pa.binary()),
                 pa.array([v.astype(np.float16).tobytes() for _, v in found], pa.binary())], names=["doc_id", "grade", "i", "v"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = joined.select("doc_id", "grade", "text").mapInArrow(run, f"doc_id {kind}, grade int, i binary, v binary") \
        .toArrow().sort_by("doc_id")
    return [(g, (np.frombuffer(i, np.int32), np.frombuffer(v, np.float16).astype(np.float32)))
            for g, i, v in zip(rows["grade"].to_pylist(), rows["i"].to_pylist(), rows["v"].to_pylist())]


def fit_model(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> OrdinalModel:
    rows = labelled_features(docs, labels, max_labels)
    features, grades = [f for _, f in rows], np.array([g for g, _ in rows], np.int64)
    return replace(fit_ordinal(features, grades), min_tail=held_out_tail(features, grades))


def held_out_tail(features: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int = 3, folds: int = FOLDS) -> float:
    """The highest least tail that keeps CLEAN_KEPT of the clean documents, each judged by
    a fit on the folds that it isn't in; its log odds are drawn to those of MIN_TAIL by
    TAIL_WEIGHT documents. One rule for any number of documents."""
    fold, tails = np.arange(len(grades)) % folds, [np.zeros(0)]
    for k in range(folds):
        clean = np.flatnonzero((fold == k) & (grades == n_grades - 1))
        if len(clean):
            model = fit_ordinal([f for f, own in zip(features, fold) if own != k], grades[fold != k], n_grades)
            tails.append(model.tails([features[i] for i in clean])[:, -1])
    tails = np.clip(np.sort(np.concatenate(tails)), 1e-12, 1 - 1e-12)
    if not len(tails):
        return MIN_TAIL
    own = tails[int((1 - CLEAN_KEPT) * len(tails))]
    odds = [np.log(p / (1 - p)) for p in (own, MIN_TAIL)]
    return float(_sigmoid((len(tails) * odds[0] + TAIL_WEIGHT * odds[1]) / (len(tails) + TAIL_WEIGHT)))


def score_texts(docs: DataFrame, model: OrdinalModel, keep: list[str], text: str = "text", min_tail: float | None = None) -> DataFrame:
    """One row per row of docs: the keep columns, expected_grade, p_poor,
    p_clean and kept (p_clean at least min_tail, by default the model's). A null text is scored as an
    empty one; repeated rows get equal scores."""
    least = model.min_tail if min_tail is None else min_tail

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            tails = model.tails(text_features([t or "" for t in batch.column("_text").to_pylist()]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), pa.array(tails.sum(1)), pa.array(1 - tails[:, 0]), pa.array(tails[:, -1]),
                 pa.array(tails[:, -1] >= least)], names=[f"c{i}" for i in range(len(keep) + 4)])

    kinds = [f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    more = [f"c{len(keep) + i} {k}" for i, k in enumerate(("double", "double", "double", "boolean"))]
    return docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(keep)], docs[text].alias("_text")) \
        .mapInArrow(run, ", ".join(kinds + more)).toDF(*keep, "expected_grade", "p_poor", "p_clean", "kept")


def drop_low_grades(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """docs without the rows that the model rejects, all columns as they were."""
    names = docs.columns
    scored = score_texts(docs, model, names)
    scored = scored.toDF(*[f"c{i}" for i in range(len(names) + 4)])
    return scored.where(f"c{len(names) + 3}").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
