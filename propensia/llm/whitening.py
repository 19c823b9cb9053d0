"""Whitening of embeddings by polarisation covariance.

No product of two dimensions is ever summed. For every dimension i and every sum
of two dimensions i + j the exact squared centred values are aggregated; as
(u + v)^2 - u^2 - v^2 = 2uv, the differences of these variances are all the
cross-covariances. Entries are integers x = floor(64 c) + 1000000, taken relative
to m = floor(S / n) of their dimension, so that they are small; the rest
R = S - n m of the mean is put right at the end in whole numbers:
sum (n x - S)^2 = n (n sum (x - m)^2) - n R^2. The matrix, assembled on the driver
(one number for each pair of dimensions), goes through ``eigh``.

Four scans of narrow rows; a task sends one row for each dimension (first scan), pair of
dimensions (second) or pair of components (third), whatever its number of rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .vectors import finite_vectors

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Entries from here on don't fit the whole numbers; their rows take no part, as those of non-finite ones.
MOST = 2.0 ** 53
#: Eigenvalues below this share of the largest are rounding errors of a zero: no component.
LEAST_SHARE = 1e-11
LIMBS = 5
_LIMB_COLUMNS = [f"l{k}" for k in range(LIMBS)]


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors).astype(np.int64) + SHIFT


def limbs(value: int) -> tuple[int, ...]:
    """A whole number as 32-bit digits, the last one signed: longs that Spark can sum without overflow."""
    digits = [(value >> 32 * k) & 0xFFFFFFFF for k in range(LIMBS - 1)]
    return *digits, value >> 32 * (LIMBS - 1)


def from_limbs(digits) -> int:
    return sum(int(d) << 32 * k for k, d in enumerate(digits))


def exact_sums(a: np.ndarray, squares: bool = False) -> np.ndarray:
    """Column sums of whole numbers (or of their squares) as Python integers."""
    top = int(np.abs(a).max(initial=0)) ** (2 if squares else 1)
    if top * len(a) >= 1 << 62:
        a = a.astype(object)
    return ((a * a) if squares else a).sum(0).astype(object)


def _limb_rows(keys: dict[str, list[int]], values: list[int]) -> pa.RecordBatch:
    digits = list(zip(*map(limbs, values))) or [()] * LIMBS
    return pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in keys.items()} |
                                      {c: pa.array(d, pa.int64()) for c, d in zip(_LIMB_COLUMNS, digits)})


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _LIMB_COLUMNS])


_LIMB_SCHEMA = ", ".join(f"{c} bigint" for c in _LIMB_COLUMNS)


def _dimension_sums(vectors: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """length -> (number of vectors, sums of x by dimension)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = defaultdict(int)
        sums: dict[int, np.ndarray] = {}
        for batch in slices(batches):
            for rows, m in finite_vectors(batch.column("vector"), MOST):
                d = m.shape[1]
                counts[d] += len(rows)
                sums[d] = sums.get(d, 0) + exact_sums(whole_numbers(m))
        for d, k in counts.items():   # dimension -1: the number of vectors
            yield _limb_rows({"d": [d] * (d + 1), "i": list(range(-1, d))}, [k, *sums[d]])

    found: dict[int, dict[int, int]] = defaultdict(dict)
    for r in _summed(vectors.mapInArrow(run, f"d bigint, i bigint, {_LIMB_SCHEMA}"), "d", "i").collect():   # a number for each dimension
        found[r.d][r.i] = from_limbs(r[2:])
    return {d: (s[-1], [s[i] for i in range(d)]) for d, s in found.items() if s[-1]}


def _pair_squares(vectors: DataFrame, middle: np.ndarray) -> dict[tuple[int, int], int]:
    """(i, j) -> exact sum of squares of the centred dimension i (i = j), or of the sum of two of them."""
    d = len(middle)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(d - lag, object) for lag in range(d)]
        for batch in slices(batches, max(1, (1 << 20) // d)):
            for rows, m in finite_vectors(batch.column("vector"), MOST):
                if m.shape[1] == d and len(rows):
                    y = whole_numbers(m) - middle
                    total[0] += exact_sums(y, squares=True)
                    for lag in range(1, d):
                        total[lag] += exact_sums(y[:, lag:] + y[:, :-lag], squares=True)
        yield _limb_rows({"i": [i for lag in range(d) for i in range(d - lag)], "j": [i + lag for lag in range(d) for i in range(d - lag)]},
                         [v for t in total for v in t])

    return {(r.i, r.j): from_limbs(r[2:]) for r in _summed(vectors.mapInArrow(run, f"i bigint, j bigint, {_LIMB_SCHEMA}"), "i", "j").collect()}


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: tuple[int, ...]       # S of each dimension
    components: np.ndarray      # unit eigenvectors as columns, largest eigenvalue first
    variances: np.ndarray       # their eigenvalues
    trace: float

    @property
    def middle(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        return [s % self.n for s in self.sums]

    def whitened(self, vectors: np.ndarray) -> np.ndarray:
        mean = np.array([r / self.n for r in self.rest])
        return ((whole_numbers(vectors) - self.middle) - mean) @ self.components / np.sqrt(self.variances)

    def deviations(self, vectors: np.ndarray) -> list[int | None]:
        """sum (n x - S)^2 of each vector; None where 64 bits don't hold it."""
        y = whole_numbers(vectors) - self.middle
        top = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if top * top * len(self.sums) >= 1 << 63:
            y = y.astype(object)
        off = y * self.n - np.array(self.rest, y.dtype)
        return [int(v) if v < 1 << 63 else None for v in (off * off).sum(1)]


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """vectors: one column ``vector``. Of several lengths the most frequent counts (the
    smaller of equals). None without a usable vector."""
    by_length = _dimension_sums(vectors)
    if not by_length:
        return None
    d = min(by_length, key=lambda k: (-by_length[k][0], k))
    n, sums = by_length[d]
    part = Whitening(n, tuple(sums), np.zeros((d, 0)), np.zeros(0), 0.0)
    squares, rest = _pair_squares(vectors, part.middle), part.rest
    # n^2 times the variance of dimension i, or of i + j
    spread = {(i, j): n * q - (rest[i] if i == j else rest[i] + rest[j]) ** 2 for (i, j), q in squares.items()}
    matrix = np.zeros((d, d))
    for (i, j), v in spread.items():
        matrix[i, j] = matrix[j, i] = float(Fraction(v if i == j else v - spread[i, i] - spread[j, j], n * n * (1 if i == j else 2)))
    values, vecs = np.linalg.eigh(matrix)
    values, vecs = values[::-1][:components], vecs[:, ::-1][:, :components]
    real = values > LEAST_SHARE * max(float(values[0]), 0.0)
    return Whitening(n, tuple(sums), vecs[:, real], values[real], float(Fraction(sum(spread[i, i] for i in range(d)), n * n)))


def _identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows, minus the identity; from the rows themselves."""
    d, k = model.components.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in slices(batches):
            for _, m in finite_vectors(batch.column("vector"), MOST):
                if m.shape[1] == d:
                    z = model.whitened(m)
                    total += z.T @ z
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i), "j": pa.array(j), "v": pa.array(total.ravel())})

    rows = vectors.mapInArrow(run, "i bigint, j bigint, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    return max((abs(r.v / model.n - (r.i == r.j)) for r in rows.collect()), default=0.0)   # components squared numbers


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """For each usable row and component: vec_id, component (from 1), n, deviation,
    whitened, explained, identity_error.

    Rows whose vector is null or empty, or holds a null, a non-finite entry or one of 2^53 or
    more take no part, nor do vectors of another length than the most frequent one.
    Repeated rows are vectors like any other; a null vec_id stays null. There are at most as
    many components as V has eigenvalues above zero (equal rows have none, and so no
    rows of result). A deviation beyond 64 bits is null. An empty table gives no rows;
    other columns play no part."""
    vectors = df.select(df[vector].alias("vector"))
    model = fit_whitening(vectors, components)
    kind = df.schema[vec_id].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if model is None or not len(model.variances):
        return df.sparkSession.createDataFrame([], schema)
    d, k = model.components.shape
    error = _identity_error(vectors, model)
    share = model.variances / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for rows, m in finite_vectors(batch.column("vector"), MOST):
                if m.shape[1] == d and len(rows):
                    size = len(rows) * k
                    row = np.repeat(np.arange(len(rows)), k)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(pa.array(rows[row])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                         pa.array(np.full(size, model.n)), pa.array(model.deviations(m), pa.int64()).take(pa.array(row)),
                         pa.array(model.whitened(m).ravel()), pa.array(np.tile(share, len(rows))), pa.array(np.full(size, error))],
                        names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return df.select(df[vec_id].alias("id"), df[vector].alias("vector")).mapInArrow(run, schema)
