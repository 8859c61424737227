"""Exact top-k inner-product search by distributed histogram selection.

Components become ``floor(scale * x)``. Queries are taken in blocks of
``block`` (a bounded broadcast); all candidates are scored against a block in
every round, and nothing but counts leaves a task: for each query a histogram
of the current score interval, from the top down to the bin that holds the
task's own kth score (lower bins cannot hold the global one). The merged
histogram names the bin of the global kth value, which is the next round's
interval, until it is one score wide. The last pass keeps scores above the kth
value, and of equal ones the k smallest ids of each task; ties go to smaller ids.

Exact: products run in float64 where |q| * |c| * dim stays below 2**53, and in
Python integers otherwise (scores beyond a long are clipped to its ends).

Defined results: vectors that are null, empty, or hold null or non-finite
components take no part, as do rows with a null id; vectors of different length
do not meet. Rows with a query's own id are its own; a repeated query row
returns its list again. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.session import cut_lineage

_EXACT = 2.0 ** 53
_LOW, _HIGH = -(2 ** 63), 2 ** 63 - 1


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id long, v array<double>) of the vectors that take part."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite)


def _matrix(vectors: list[np.ndarray], scale: int) -> np.ndarray:
    return np.floor(np.stack(vectors) * float(scale))


def _by_length(ids: np.ndarray, vectors: list) -> Iterator[tuple[int, np.ndarray, list]]:
    lengths = np.array([len(v) for v in vectors])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield int(n), ids[at], [np.asarray(vectors[i], dtype=np.float64) for i in at]


class QueryBlock:
    """Queries of one length with their current score intervals."""

    def __init__(self, ids: np.ndarray, vectors: list[np.ndarray], scale: int, first: int):
        self.ids, self.scale, self.first = ids, scale, first
        self.matrix = _matrix(vectors, scale)
        self.length = self.matrix.shape[1]
        self.bound = float(np.abs(self.matrix).max(initial=0.0))

    def scores(self, vectors: list[np.ndarray]) -> np.ndarray:
        """(queries, candidates) as int64, exact."""
        other = _matrix(vectors, self.scale)
        if self.bound * float(np.abs(other).max(initial=0.0)) * self.length < _EXACT:
            return (self.matrix @ other.T).astype(np.int64)
        whole = [[int(x) for x in row] for row in other]
        mine = [[int(x) for x in row] for row in self.matrix]
        return np.array([[min(max(sum(a * b for a, b in zip(q, c, strict=True)), _LOW), _HIGH) for c in whole] for q in mine], dtype=np.int64)


def _scored(batches: Iterator[pa.RecordBatch], blocks: list[QueryBlock]):
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            ids = part.column(0).to_numpy(zero_copy_only=False)
            for n, own, vectors in _by_length(ids, part.column(1).to_pylist()):
                for b, block in enumerate(blocks):
                    if block.length == n:
                        scores = block.scores(vectors)
                        yield b, block, own, scores, block.ids[:, None] != own[None, :]


def _range(rows: DataFrame, handle) -> dict[int, tuple[int, int, int]]:
    """(lowest, highest, number) of each query's scores."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[int, list[np.ndarray]] = {}
        for b, block, _, scores, free in _scored(batches, handle.value):
            low = np.where(free, scores, _HIGH).min(axis=1)
            high = np.where(free, scores, _LOW).max(axis=1)
            n = free.sum(axis=1)
            if b in state:
                low, high, n = np.minimum(state[b][0], low), np.maximum(state[b][1], high), state[b][2] + n
            state[b] = [low, high, n]
        for b, (low, high, n) in state.items():
            q = np.arange(len(n)) + handle.value[b].first
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (q, low, high, n)], names=["q", "low", "high", "n"])

    merged = rows.mapInArrow(work, "q long, low long, high long, n long").groupBy("q").agg(F.min("low"), F.max("high"), F.sum("n"))
    return {r[0]: (r[1], r[2], r[3]) for r in merged.collect() if r[3]}  # one row per query of the block


def _refined(rows: DataFrame, handle, low: np.ndarray, top: np.ndarray, width: np.ndarray, need: np.ndarray, bins: int) -> DataFrame:
    """(q, bin, n): counts of the bins of each query's interval, from the top to the task's own kth."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b, block, _, scores, free in _scored(batches, handle.value):
            q = slice(block.first, block.first + len(block.ids))
            cell = (scores - low[q, None]) // width[q, None]
            ok = free & (scores >= low[q, None]) & (scores <= top[q, None]) & (cell >= 0) & (cell < bins)
            flat = (np.arange(len(block.ids))[:, None] * bins + cell)[ok]
            count = np.bincount(flat, minlength=len(block.ids) * bins).reshape(-1, bins)
            held[b] = held[b] + count if b in held else count
        for b, count in held.items():
            block = handle.value[b]
            want = need[block.first:block.first + len(block.ids), None]
            above = np.cumsum(count[:, ::-1], axis=1)[:, ::-1] - count
            q, cell = np.nonzero((count > 0) & (above < want))
            yield pa.RecordBatch.from_arrays([pa.array(q + block.first), pa.array(cell.astype(np.int32)), pa.array(count[q, cell])],
                                             names=["q", "bin", "n"])

    return rows.mapInArrow(work, "q long, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))


def _kth_values(rows: DataFrame, handle, total: int, k: int, bins: int) -> np.ndarray:
    """The kth highest score of each query (the lowest, if there are fewer than k)."""
    ranges = _range(rows, handle)
    low, top, need = (np.zeros(total, dtype=np.int64) for _ in range(3))
    width = np.ones(total, dtype=np.int64)
    for q, (least, most, n) in ranges.items():
        low[q], top[q], need[q] = least, most, min(k, n)
        width[q] = max(1, (int(most) - int(least)) // bins + 1)
    open_ = need > 0
    while open_.any():
        wanted = np.where(open_, need, 0)
        counts = _refined(rows, handle, low, top, width, wanted, bins)
        for row in (counts.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("bin", "n")), asc=False).alias("bins")).collect()):
            q, above = row["q"], 0  # at most `bins` entries for each query of the block
            for cell, n in row["bins"]:
                if above + n >= need[q]:
                    break
                above += n
            low[q] += cell * width[q]
            top[q] = min(top[q], low[q] + (width[q] - 1))
            need[q] -= above
        open_ &= width > 1
        width = np.where(open_, (width - 1) // bins + 1, 1)
    return low


def _selected(rows: DataFrame, handle, kth: np.ndarray, k: int) -> DataFrame:
    """(q, query_id, vec_id, score): scores above the kth value, and each task's k smallest ids of equal ones."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ties: dict[int, list[int]] = {}
        owner: dict[int, int] = {}
        for _, block, own, scores, free in _scored(batches, handle.value):
            limit = kth[block.first:block.first + len(block.ids), None]
            q, c = np.nonzero(free & (scores > limit))
            if len(q):
                yield _hits(q + block.first, block.ids[q], own[c], scores[q, c])
            equal = free & (scores == limit)
            for q in np.flatnonzero(equal.any(axis=1)):
                at = int(q) + block.first
                ties[at] = sorted([*ties.get(at, ()), *own[equal[q]].tolist()])[:k]
                owner[at] = int(block.ids[q])
        for q, ids in ties.items():
            yield _hits(np.full(len(ids), q), np.full(len(ids), owner[q]), np.array(ids), np.full(len(ids), kth[q]))

    return rows.mapInArrow(work, "q long, query_id long, vec_id long, score long")


def _hits(*cols: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["q", "query_id", "vec_id", "score"])


def search(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = 1024, block: int = 1024, bins: int = 1024) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest integer inner products of each query row."""
    spark = df.sparkSession
    rows = quantised(df, id_col, vector_col, scale)
    results, pending = [], []

    def run(chunk: list) -> None:
        ids = np.array([r["id"] for r in chunk], dtype=np.int64)
        blocks, first = [], 0
        for _, own, vectors in _by_length(ids, [r["v"] for r in chunk]):
            blocks.append(QueryBlock(own, vectors, scale, first))
            first += len(own)
        handle = spark.sparkContext.broadcast(blocks)  # `block` vectors at most
        kth = _kth_values(rows, handle, first, k, bins)
        best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        hits = _selected(rows, handle, kth, k).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        results.append(cut_lineage(hits.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")))
        handle.unpersist()

    for row in quantised(queries, id_col, vector_col, scale).toLocalIterator():
        pending.append(row)
        if len(pending) == block:
            run(pending)
            pending = []
    if pending:
        run(pending)
    if not results:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out
