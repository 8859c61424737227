"""J18 with nulls in the features: exact k nearest donors under the nan-aware Euclidean distance.

Two rows share the coordinates S that both have; their squared distance is the
sum over S times (all features / size of S), and rows that share none are no
neighbours. A null is filled with the mean of its k nearest donors (rows of the
fit frame that have the target; ties by id), or the column's mean if it has none.

A probe with the coordinates P meets the donors of each kind D (the coordinates they
have) over S = P & D, whatever the target: one copy of a donor a (D, S) serves all
patterns and targets. The copies of (D, S) are cut into boxes at medians of a
sample (its size bounds the driver's part; every donor is in a box), and equal
vectors are reduced to their first k by id, before and after the shuffle. Round
1 compares a probe with the box around it in the largest kind that has its
targets; the k-th distance there bounds the search. Round 2 takes it to every
box, of all kinds, that the bound reaches. Pairs are compared within a box's task
and only the k nearest leave it, so that what is shuffled are donors and
probes, not pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.operators.boxes import Boxes, Near, codes_of, cut_boxes, first_of_equal
from tabforge.session import cut_lineage

MAX_FEATURES = 20  # a mask is collected for each pattern
#: Donors that cut the boxes.
SAMPLE_ROWS = 65_536
#: Donors of a box, about.
BOX_ROWS = 32_768
#: Donors of a task, about.
TASK_ROWS = 131_072
#: Stands for a null id, which comes first.
NULL_ID = -(1 << 63)

_ROWS = "_pid long, _mask long, _want long, _far double, _x binary"
_PLACED = f"_box int, _side int, {_ROWS}"


def _mask(feats: Sequence[str]) -> Column:
    total = F.lit(0).cast("long")
    for j, c in enumerate(feats):
        total = total + F.when(F.col(c).isNotNull(), F.lit(1 << j)).otherwise(F.lit(0))
    return total


def _of(mask: int, n: int) -> list[int]:
    return [j for j in range(n) if mask >> j & 1]


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).fill_null(NULL_ID).to_numpy()


def _packed(x: np.ndarray) -> pa.Array:
    """A row's numbers as one binary value."""
    width = x.shape[1] * 8
    ends = np.arange(len(x) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(x))])


def _unpacked(batch: pa.RecordBatch, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(batch.schema.get_field_index("_x")).to_pylist())).reshape(-1, n)


def _batch(schema: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=[c.split()[0] for c in schema.split(", ")])


@dataclass
class Plan:
    """Boxes of each (kind, shared coordinates), numbered through from ``firsts``; targets of each pattern by the kind that bounds them."""

    n: int
    k: int
    keys: list[tuple[int, int]]
    boxes: list[Boxes]
    firsts: np.ndarray
    homes: dict[int, dict[int, int]]

    def scale(self, shared: int) -> float:
        return self.n / shared.bit_count()

    def points(self, batches: Iterator[pa.RecordBatch], kept: set[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
        """Donors in the boxes of the ``kept`` keys."""
        for batch in batches:
            ids, masks = _longs(batch, "_pid"), _longs(batch, "_mask")
            x = self._wide(batch)
            for at, (kind, shared) in enumerate(self.keys):
                own = np.flatnonzero(masks == kind) if (kind, shared) in kept else ()
                if len(own):
                    own = own[first_of_equal(x[np.ix_(own, _of(shared, self.n))], ids[own], self.k)]
                    box = self.firsts[at] + self.boxes[at].home(x[np.ix_(own, _of(shared, self.n))])
                    yield self._placed(box, 0, ids[own], masks[own], np.zeros(len(own), np.int64), np.zeros(len(own)), x[own])

    def first(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Probes in the box around them in each kind that bounds some of their targets."""
        for batch in batches:
            ids, masks, x = _longs(batch, "_pid"), _longs(batch, "_mask"), self._wide(batch)
            for pattern in np.unique(masks).tolist():
                own = np.flatnonzero(masks == pattern)
                for kind, want in self.homes[pattern].items():
                    at = self.keys.index((kind, pattern & kind))
                    box = self.firsts[at] + self.boxes[at].home(x[np.ix_(own, _of(pattern & kind, self.n))])
                    yield self._placed(box, 1, ids[own], masks[own], np.full(len(own), want), np.full(len(own), np.inf), x[own])

    def again(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Probes in all boxes within their bound."""
        for batch in batches:
            ids, masks, wants, far = (batch.column(i).to_numpy() for i in range(4))
            x = _unpacked(batch, self.n)
            for pattern, want in sorted(set(zip(masks.tolist(), wants.tolist(), strict=True))):
                own = np.flatnonzero((masks == pattern) & (wants == want))
                for at, (kind, shared) in enumerate(self.keys):
                    if pattern & kind == shared and want & kind:
                        rows, box = self.boxes[at].within(x[np.ix_(own, _of(shared, self.n))], far[own], self.scale(shared))
                        if len(rows):
                            r = own[rows]
                            yield self._placed(self.firsts[at] + box, 1, ids[r], masks[r], wants[r], far[r], x[r])

    def _wide(self, batch: pa.RecordBatch) -> np.ndarray:
        return np.column_stack([batch.column(batch.schema.get_field_index(f"x{j}")).to_numpy(zero_copy_only=False).astype(np.float64) for j in range(self.n)])

    def _placed(self, box, side, ids, masks, wants, far, x) -> pa.RecordBatch:
        return _batch(_PLACED, box.astype(np.int32), np.full(len(box), side, np.int32), ids, masks, wants, far, _packed(x))

    def _met(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(kind, donors, their ids, batch of probes, their rows, first hit and hits of each, donor and distance of the hits):
        sorted rows of the boxes, donors before probes."""
        held, near, box = [], None, -1
        for batch in batches:
            numbers, sides = (batch.column(i).to_numpy() for i in range(2))
            x = _unpacked(batch, self.n)
            starts = np.flatnonzero(np.diff(numbers * 2 + sides, prepend=-1))
            for s, e in zip(starts, [*starts[1:], len(numbers)]):  # no starts without rows
                if numbers[s] != box:
                    held, near, box = [], None, numbers[s]
                    at = int(np.searchsorted(self.firsts, box, side="right")) - 1
                    kind, shared = self.keys[at]
                    cols = _of(shared, self.n)
                part = batch.slice(s, e - s)
                if not sides[s]:
                    held.append((_longs(part, "_pid"), x[s:e]))
                    continue
                if not held:
                    continue
                if near is None:
                    ids, donors = (np.concatenate(c) for c in zip(*held, strict=True))
                    own = first_of_equal(donors[:, cols], ids, self.k)
                    ids, donors = ids[own], donors[own]
                    near = Near(donors[:, cols], self.scale(shared), self.k)
                far = part.column(5).to_numpy()
                once, code = codes_of(np.column_stack([far, x[s:e][:, cols]]))  # equal probes have equal neighbours
                row, donor, d2 = near(x[s:e][once][:, cols], far[once])
                begin = np.searchsorted(row, np.arange(len(once) + 1))
                yield kind, donors, ids, part, x[s:e], begin[code], np.diff(begin)[code], donor, d2

    def bound(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Probes with their k-th distance."""
        for _, _, _, part, x, begin, hits, _, d2 in self._met(batches):
            whole = hits == self.k
            far = np.full(len(x), np.inf)
            far[whole] = d2[begin[whole] + self.k - 1]
            yield _batch(_ROWS, part.column(2), part.column(3), part.column(4), far, _packed(x))

    def found(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Probe, target, distance, donor and its value of the target, the k nearest of each box."""
        for kind, donors, ids, part, x, begin, hits, donor, d2 in self._met(batches):
            r = np.repeat(np.arange(len(x)), hits)
            h = np.repeat(begin, hits) + np.arange(len(r)) - np.repeat(np.cumsum(hits) - hits, hits)
            probe, want = part.column(2).to_numpy()[r], part.column(4).to_numpy()[r]
            for t in _of(kind, self.n):
                on = want >> t & 1 > 0
                if on.any():
                    p = donor[h[on]]
                    yield _batch(_FOUND, probe[on], np.full(len(p), t, np.int32), d2[h[on]], ids[p], donors[p, t])


_FOUND = "_pid long, _t int, _d2 double, i long, value double"


def _plan(given: DataFrame, counts: dict[int, int], patterns: Sequence[int], n: int, k: int, box_rows: int) -> Plan:
    homes: dict[int, dict[int, int]] = {}
    for p in patterns:
        homes[p] = {}
        for t in range(n):
            kinds = [d for d in counts if d >> t & 1 and d & p]
            if not p >> t & 1 and kinds:
                best = max(kinds, key=lambda d: (counts[d], -d))
                homes[p][best] = homes[p].get(best, 0) | 1 << t
    keys = sorted({(d, d & p) for p in patterns for d in counts if d & p and d & ~p})
    share = math.ceil(SAMPLE_ROWS / max(1, sum(counts.values())) * (1 << 20))
    xs = [f"x{j}" for j in range(n)]
    sample = given.where(F.pmod(F.xxhash64("_pid"), F.lit(1 << 20)) < share).limit(2 * SAMPLE_ROWS).select("_mask", *xs).collect()
    masks = np.array([r[0] for r in sample], dtype=np.int64)
    x = np.array([r[1:] for r in sample], dtype=np.float64).reshape(-1, n)
    boxes = []
    for kind, shared in keys:
        own = x[masks == kind][:, _of(shared, n)]
        own = own[codes_of(own)[0]] if len(own) else own
        boxes.append(cut_boxes(own, max(4, math.ceil(len(own) / math.ceil(counts[kind] / box_rows))))[0])
    firsts = np.cumsum([0, *map(len, boxes)])[:-1]
    return Plan(n, k, keys, boxes, firsts, homes)


def knn_impute_masked(df: DataFrame, donors: DataFrame, id_col: str, features: Sequence[str], k: int = 5,
                      cells_per_bucket: int = BOX_ROWS) -> DataFrame:
    """``df`` with the nulls of all ``features`` filled (as doubles) from ``donors``. ``id_col`` is unique and of whole
    numbers. A feature that no donor has stays null; NaN counts as null; other columns stay as they are. ``cells_per_bucket``:
    donors of a box. Both frames are read several times."""
    feats = list(features)
    n_feats = len(feats)
    if n_feats > MAX_FEATURES:
        raise ValueError(f"at most {MAX_FEATURES} features")

    def clean(x: DataFrame) -> DataFrame:
        return x.select(F.col(id_col).cast("long").alias("_pid"),
                        *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"x{j}") for j, c in enumerate(feats)]
                        ).withColumn("_mask", _mask([f"x{j}" for j in range(n_feats)]))

    xs = [f"x{j}" for j in range(n_feats)]
    given = clean(donors)
    probes = clean(df).where(F.col("_mask") != (1 << n_feats) - 1)
    patterns = sorted(r[0] for r in probes.select("_mask").distinct().collect())  # at most 2**features numbers
    kinds = given.groupBy("_mask").agg(F.count(F.lit(1)), *[F.sum(x) for x in xs]).collect()  # as many
    counts = {r[0]: r[1] for r in kinds}
    known = [sum(n for d, n in counts.items() if d >> j & 1) for j in range(n_feats)]
    means = [sum(r[2 + j] for r in kinds if r[0] >> j & 1) / known[j] if known[j] else None for j in range(n_feats)]

    fills = None
    plan = _plan(given, counts, patterns, n_feats, k, int(cells_per_bucket)) if patterns else None
    if plan and plan.keys:
        shared = df.sparkSession.sparkContext.broadcast(plan)  # cuts of the sample
        homes = {(d, d & p) for p, kinds in plan.homes.items() for d in kinds}

        def by_box(asked: DataFrame, kept: set[tuple[int, int]]) -> DataFrame:
            """Donors of the ``kept`` keys and probes, each box in one task, donors first."""
            own = given.mapInArrow(lambda batches: shared.value.points(batches, kept), _PLACED)
            copies = sum(counts[d] for d, _ in kept)
            n_boxes = sum(len(b) for key, b in zip(plan.keys, plan.boxes, strict=True) if key in kept)
            parts = max(1, min(n_boxes, max(df.sparkSession.sparkContext.defaultParallelism, copies // TASK_ROWS)))
            return own.unionByName(asked).repartition(parts, "_box").sortWithinPartitions("_box", "_side")

        first = by_box(probes.mapInArrow(lambda batches: shared.value.first(batches), _PLACED), homes)
        bounded = first.mapInArrow(lambda batches: shared.value.bound(batches), _ROWS)
        again = by_box(bounded.mapInArrow(lambda batches: shared.value.again(batches), _PLACED), set(plan.keys))
        found = again.mapInArrow(lambda batches: shared.value.found(batches), _FOUND).repartition("_pid")
        w = Window.partitionBy("_pid", "_t").orderBy("_d2", "i")
        nearest = found.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
        by_target = nearest.groupBy("_pid", "_t").agg(F.avg("value").alias("_fill"))
        fills = by_target.groupBy("_pid").agg(*[F.max(F.when(F.col("_t") == j, F.col("_fill"))).alias(f"f{j}") for j in range(n_feats)])
        fills = cut_lineage(fills)

    out = df
    if fills is not None:
        out = out.join(fills.withColumnRenamed("_pid", "_knn_id"), F.col(id_col).cast("long") == F.col("_knn_id"), "left").drop("_knn_id")
    for j, c in enumerate(feats):
        filled = [F.col(f"f{j}")] if fills is not None else []
        out = out.withColumn(c, F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), *filled, F.lit(means[j]).cast("double")))
    return out.drop(*[f"f{j}" for j in range(n_feats)]) if fills is not None else out
