"""Whitening of embeddings by exact polarisation covariance.

Components become integers x = floor(scale * c) + shift. A first pass gives n
and the sums S; m = floor(S / n) centres every x to a small integer y = x - m,
off the true mean by r / n with r = S - n * m. A second pass adds up, exactly,
the squares of y_i and of y_i + y_j for every dimension and every pair. With
the remainder put back, sum((n*x_i - S_i)^2) = n^2 * sum(y_i^2) - n * r_i^2, and
for a pair r_i + r_j takes the place of r_i: squares of exactly centred values.
A pair's covariance is half of what the variance of its sum exceeds the two
variances by. All of that is whole numbers; each covariance is rounded once, to a double, for ``eigh``.

Only n, S and the d * (d + 1) / 2 sums of squares reach the driver: their
number depends on the dimension, not on the rows. Rows are projected in tasks,
and the covariance of what comes out is measured over all rows for ``identity_error``.

Sums stay in 64-bit integers per batch where they fit and in Python integers
where not; Spark adds them as longs of 32-bit limbs.

Defined results: vectors that are null, empty, or hold null or non-finite entries are
dropped; of different lengths the most frequent one stays (of equals the
longer). Entries beyond +-2**53 are cut there before scaling; a deviation beyond a long is
the largest long. Components whose eigenvalue is not above d * 2**-52 of the largest
one (all, where all vectors are equal) have no direction of their own and give no
rows. Repeated rows and null ids are rows like others; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LONG = 2 ** 63 - 1
_EDGE = 2.0 ** 53


def remaining(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<double>) of the vectors that take part, all of one length."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    length = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("v") == (length["d"] if length else 0))


def whole(vectors: pa.Array, scale: int, shift: int) -> np.ndarray:
    """Rows of x as int64."""
    lists = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    flat = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
    return np.floor(np.clip(flat, -_EDGE, _EDGE) * float(scale)).astype(np.int64) + shift


def _parts(batches: Iterator[pa.RecordBatch], column: int, size: int = 2048):
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            part = batch.slice(start, size)
            if part.num_rows:
                yield part, part.column(column)


_LIMBS = 5


def _sums(rows: DataFrame, work) -> dict[int, int]:
    """{key: exact sum} of the rows that tasks give; as many keys as the dimension asks for."""
    names = [f"l{i}" for i in range(_LIMBS)]
    got = rows.mapInArrow(work, "key int, " + ", ".join(f"{c} long" for c in names)).groupBy("key").agg(*[F.sum(c).alias(c) for c in names])
    return {r["key"]: sum(r[c] << 32 * i for i, c in enumerate(names)) for r in got.collect()}


def _batch(keys: np.ndarray, values) -> pa.RecordBatch:
    """Each value as 32-bit limbs, the lowest first; the highest takes the sign and the rest."""
    values = [int(v) for v in values]
    low = [pa.array([(v >> 32 * i) & 0xFFFFFFFF for v in values], pa.int64()) for i in range(_LIMBS - 1)]
    high = pa.array([v >> 32 * (_LIMBS - 1) for v in values], pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), *low, high], names=["key", *[f"l{i}" for i in range(_LIMBS)]])


def _totals(rows: DataFrame, scale: int, shift: int) -> tuple[int, list[int]]:
    """n and the sum of each dimension."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, vectors in _parts(batches, 0):
            x = whole(vectors, scale, shift)
            hi, lo = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)  # 2048 rows: far inside a long
            own = np.append(hi.astype(object) * (1 << 32) + lo.astype(object), len(x))
            total = own if total is None else total + own
        if total is not None:
            yield _batch(np.arange(len(total)), total)

    sums = _sums(rows.select("v"), work)
    return (sums.pop(max(sums)), [sums[i] for i in sorted(sums)]) if sums else (0, [])


def _squares(y: np.ndarray) -> np.ndarray:
    """Sums over rows of (y_i + y_j)^2 for j > i and of y_i^2 on the diagonal, exact; upper triangle by rows."""
    bound = int(np.abs(y).max(initial=0))
    if 4 * bound * bound * len(y) >= _LONG:
        y = y.astype(object)
    out = []
    for i in range(y.shape[1]):
        own = y[:, i]
        out.append((own * own).sum())
        pair = y[:, i + 1:] + own[:, None]
        out.extend((pair * pair).sum(axis=0))
    return np.array(out, dtype=object)


def _pair_squares(rows: DataFrame, centre: np.ndarray, scale: int, shift: int) -> dict[int, int]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, vectors in _parts(batches, 0):
            own = _squares(whole(vectors, scale, shift) - centre)
            total = own if total is None else total + own
        if total is not None:
            yield _batch(np.arange(len(total)), total)

    return _sums(rows.select("v"), work)


def covariance(n: int, totals: list[int], centre: list[int], squares: dict[int, int]) -> np.ndarray:
    """Covariances (divisor n), each the double nearest to the exact value."""
    d = len(totals)
    rest = [s - n * m for s, m in zip(totals, centre, strict=True)]
    exact = {}
    key = 0
    for i in range(d):
        for j in range(i, d):
            r = rest[i] if i == j else rest[i] + rest[j]
            exact[i, j] = n * squares[key] - r * r  # variance of the dimension or of the pair's sum, times n^2
            key += 1
    out = np.zeros((d, d))
    for (i, j), v in exact.items():
        out[i, j] = out[j, i] = float(Fraction(v, n * n) if i == j else Fraction(v - exact[i, i] - exact[j, j], 2 * n * n))
    return out


@dataclass
class Whitening:
    """What the fit list gives: ``axes`` has one column per component, over the root of its eigenvalue."""

    n: int
    centre: np.ndarray
    rest: np.ndarray
    axes: np.ndarray
    explained: np.ndarray
    scale: int
    shift: int

    def centred(self, vectors: pa.Array) -> np.ndarray:
        return whole(vectors, self.scale, self.shift) - self.centre

    def project(self, y: np.ndarray) -> np.ndarray:
        return (y - self.rest.astype(np.float64) / self.n) @ self.axes

    def deviations(self, y: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n*x - S)^2, exact."""
        bound = self.n * (int(np.abs(y).max(initial=0)) + 1)
        z = (y if y.shape[1] * bound * bound < _LONG else y.astype(object)) * self.n - self.rest
        squares = (z * z).sum(axis=1)
        return np.array([min(int(v), _LONG) for v in squares], dtype=np.int64)


def fit(rows: DataFrame, components: int = 32, scale: int = 64, shift: int = 1_000_000) -> Whitening | None:
    """Whitening of (id, v) rows; None without rows."""
    n, totals = _totals(rows, scale, shift)
    if not n:
        return None
    centre = [s // n for s in totals]
    squares = _pair_squares(rows, np.array(centre, dtype=np.int64), scale, shift)
    v = covariance(n, totals, centre, squares)
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > max(0.0, float(values.max())) * len(v) * 2.0 ** -52]
    chosen = vectors[:, order]
    if len(order):
        chosen = chosen * np.sign(chosen[np.abs(chosen).argmax(axis=0), np.arange(len(order))])
    rest = np.array([s - n * m for s, m in zip(totals, centre, strict=True)], dtype=np.int64)
    trace = float(np.trace(v))
    return Whitening(n, np.array(centre, dtype=np.int64), rest, chosen / np.sqrt(values[order]),
                     values[order] / trace if trace else values[order], scale, shift)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over all rows."""
    k = model.axes.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, total = np.zeros((k, k)), np.zeros(k)
        for _, vectors in _parts(batches, 0):
            w = model.project(model.centred(vectors))  # centred: the exact mean is taken off before the projection
            gram += w.T @ w
            total += w.sum(axis=0)
        flat = np.concatenate([gram.ravel(), total])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["key", "s"])

    got = {r["key"]: r["s"] for r in rows.select("v").mapInArrow(work, "key int, s double").groupBy("key").agg(F.sum("s").alias("s")).collect()}
    flat = np.array([got[i] for i in range(k * k + k)])
    mean = flat[k * k:] / model.n
    return float(np.abs(flat[:k * k].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32, scale: int = 64,
           shift: int = 1_000_000) -> DataFrame:
    """id, component (from 1), n, deviation, whitened, explained, identity_error; one row per vector and component."""
    rows = remaining(df, id_col, vector_col)
    id_type = rows.schema["id"].dataType.simpleString()
    schema = (f"`{id_col}` {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    model = fit(rows, components, scale, shift)
    if model is None or not model.axes.shape[1]:
        return df.sparkSession.createDataFrame([], schema)
    k, error = model.axes.shape[1], identity_error(rows, model)
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, vectors in _parts(batches, 1):
            y = model.centred(vectors)
            m = len(y)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, model.n)), pa.array(np.repeat(model.deviations(y), k)), pa.array(model.project(y).ravel()),
                 pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, error))], names=names)

    return rows.select("id", "v").mapInArrow(work, schema)
