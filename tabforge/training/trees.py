"""Trees of many models grown side by side from shared histograms.

A step takes all nodes that wait for a split, in every tree of every model and
fold. Tasks count their blocks into histograms (tree, node, feature, bin); these
are shuffled by tree and added up, and the best split of each node comes back.
Sums of gradients are whole numbers (units of 2**-30), so that a split depends
neither on the order of addition nor on which other models are trained along.

Trees live in flat arrays: the children of a node are two neighbouring
entries. ``Split`` rules: a row goes left where its bin is at most ``cut``;
nulls (bin 0) go to the side that gains more.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabforge.training.blocks import CELL_COLUMNS, ROW_COLUMNS, Cells, Condition, Packed, cells_of, uniform, unpacked

UNIT = float(1 << 30)


@dataclass(frozen=True)
class TreePlan:
    """How one tree grows.

    criterion: ``gini`` (counts of label 0/1), ``variance`` (of gradients), or ``newton`` (gradients and Hessians with
    ``l1``, ``l2``). ``leaves`` bounds the leaves by best-first growth; 0 grows level by level.
    """

    model: int
    seed: int
    conditions: tuple[Condition, ...]
    allowed: tuple[int, ...]
    criterion: str = "gini"
    max_depth: int = 5
    leaves: int = 0
    min_split: int = 2
    min_leaf: int = 1
    min_hessian: float = 0.0
    min_gain: float = 0.0
    l1: float = 0.0
    l2: float = 0.0
    node_features: int = 0
    tree_features: float = 1.0
    subsample: float = 1.0
    bootstrap: bool = False

    @property
    def channels(self) -> int:
        return 2 if self.criterion == "gini" else 3


@dataclass
class Routes:
    """What sends rows down the trees; this is what tasks get."""

    feature: np.ndarray
    cut: np.ndarray
    null_left: np.ndarray
    left: np.ndarray

    def leaf_of(self, root: int, bins: np.ndarray) -> np.ndarray:
        """Leaf of each row in the tree of ``root``."""
        node = np.full(len(bins), root, dtype=np.int32)
        rows = np.arange(len(bins)) if self.cut[root] >= 0 else np.zeros(0, np.int64)
        flat, d = bins.reshape(-1), bins.shape[1]
        while len(rows):
            at = node[rows]
            b = flat.take(rows * d + self.feature[at])
            right = np.where(b == 0, ~self.null_left[at], b > self.cut[at])
            at = self.left[at] + right
            node[rows] = at
            rows = rows[self.cut[at] >= 0]
        return node


@dataclass
class Forest:
    """Flat trees; node ``i < len(plans)`` is the root of tree ``i``. ``cut`` < 0 marks a leaf."""

    plans: list[TreePlan]
    tree: np.ndarray
    depth: np.ndarray
    path: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    null_left: np.ndarray
    left: np.ndarray
    gain: np.ndarray
    stats: np.ndarray

    @staticmethod
    def roots(plans: list[TreePlan]) -> Forest:
        n = len(plans)
        return Forest(plans, np.arange(n, dtype=np.int32), np.zeros(n, np.int16), np.ones(n, np.uint64), np.zeros(n, np.int16),
                      np.full(n, -1, np.int16), np.zeros(n, bool), np.full(n, -1, np.int32), np.zeros(n), np.zeros((n, 3), np.int64))

    def split(self, nodes: np.ndarray, feature, cut, null_left, gain, left_stats) -> np.ndarray:
        """Splits ``nodes``; returns the children, left and right by turns."""
        first = len(self.tree)
        self.feature[nodes], self.cut[nodes], self.null_left[nodes], self.gain[nodes] = feature, cut, null_left, gain
        self.left[nodes] = first + 2 * np.arange(len(nodes), dtype=np.int32)
        k = 2 * len(nodes)
        path = np.repeat(self.path[nodes] * np.uint64(2), 2)
        path[1::2] += np.uint64(1)
        stats = np.repeat(self.stats[nodes], 2, axis=0)
        stats[0::2] = left_stats
        stats[1::2] -= left_stats
        for name, new in (("tree", np.repeat(self.tree[nodes], 2)), ("depth", np.repeat(self.depth[nodes] + 1, 2)), ("path", path),
                          ("feature", np.zeros(k)), ("cut", np.full(k, -1)), ("null_left", np.zeros(k)), ("left", np.full(k, -1)),
                          ("gain", np.zeros(k)), ("stats", stats)):
            old = getattr(self, name)
            setattr(self, name, np.concatenate([old, new.astype(old.dtype)]))
        return np.arange(first, first + k)

    def routes(self) -> Routes:
        return Routes(self.feature, self.cut, self.null_left, self.left)


# -- counting -------------------------------------------------------------------------------------------------
_POISSON = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, k + 1, dtype=float)) for k in range(12)])


def _draw(plan: TreePlan) -> tuple:
    """What a plan's drawing of rows depends on."""
    return plan.seed, plan.bootstrap, plan.subsample


def drawn(own: Cells, plan: TreePlan) -> np.ndarray:
    """How many rows of each cell are drawn, resampled by key and seed; held-out cells too."""
    if plan.bootstrap:
        times = np.searchsorted(_POISSON, uniform(own.keys, plan.seed), side="right")
        return np.bincount(own.cell_of, times, len(own)).astype(np.int64)
    if plan.subsample < 1.0:
        return np.bincount(own.cell_of[uniform(own.keys, plan.seed) < plan.subsample], minlength=len(own)).astype(np.int64)
    return own.counts


@dataclass
class Step:
    """What a task needs to count: the trees so far and the nodes that wait, ordered by tree."""

    plans: list[TreePlan]
    routes: Routes
    nodes: np.ndarray
    slot: np.ndarray
    first: np.ndarray
    candidates: np.ndarray
    n_bins: int

    def count(self, t: int) -> int:
        return int(self.first[t + 1] - self.first[t])

    def features(self, t: int) -> np.ndarray:
        c = self.candidates[self.first[t]:self.first[t + 1]]
        return c[:, :int((c[0] >= 0).sum())]


def _candidates(forest: Forest, nodes: np.ndarray) -> np.ndarray:
    """Features that each node may split on, -1 beyond their number; drawn by the seed, the node's path and the feature."""
    widest = max(len(p.allowed) for p in forest.plans)
    out = np.full((len(nodes), widest), -1, dtype=np.int16)
    trees = forest.tree[nodes]
    keyed: dict[tuple, list[int]] = {}
    for t in np.unique(trees):
        p = forest.plans[t]
        keyed.setdefault((p.allowed, p.node_features, p.tree_features), []).append(int(t))
    for (allowed, k, share), of in keyed.items():
        at = np.flatnonzero(np.isin(trees, of))
        names = np.array(allowed, dtype=np.int16)
        if 0 < k < len(names):
            base = np.array([forest.plans[t].seed for t in trees[at]], dtype=np.uint64) ^ (forest.path[nodes[at]] * np.uint64(0x9E3779B97F4A7C15))
        elif share < 1.0:
            k = max(1, round(share * len(names)))
            base = np.array([forest.plans[t].seed for t in trees[at]], dtype=np.uint64)
        else:
            out[at, :len(names)] = names
            continue
        u = np.stack([uniform(base, 0xD1B54A32D192ED03 * (int(f) + 1)) for f in names], axis=1)
        out[at, :k] = np.sort(names[np.argsort(u, axis=1, kind="stable")[:, :k]], axis=1)
    return out


def _encode(h: np.ndarray) -> tuple[bytes, bytes]:
    """(cells, sums) of the filled cells, or (empty, all sums) where that is shorter."""
    filled = np.flatnonzero(h[0])
    if (len(h) * 8 + 4) * len(filled) < h.size * 8:
        return filled.astype(np.int32).tobytes(), np.ascontiguousarray(h[:, filled]).tobytes()
    return b"", np.ascontiguousarray(h).tobytes()


def histogram(own: Cells, step: Step, t: int, gradients: tuple[np.ndarray, np.ndarray] | None, times: np.ndarray) -> np.ndarray | None:
    """(channels, slots * features * bins) sums of one block for the waiting nodes of tree ``t``; each cell counts ``times``."""
    plan = step.plans[t]
    at = np.flatnonzero(times * own.trains(plan.conditions))
    if not len(at):
        return None
    slots = step.slot[step.routes.leaf_of(t, own.bins[at])] - step.first[t]
    inside = (slots >= 0) & (slots < step.count(t))
    if not inside.all():
        at, slots = at[inside], slots[inside]
    if not len(at):
        return None
    features = step.features(t)
    k, n = features.shape[1], step.count(t)
    weight, bins = times[at], own.bins[at]
    sums = [weight, weight * own.labels[at]] if gradients is None else [weight, weight * gradients[0][at], weight * gradients[1][at]]
    sums = [s.astype(np.float64) for s in sums]  # whole numbers below 2**53 in a block
    out = np.empty((len(sums), n, k, step.n_bins), dtype=np.int64)
    base, rows = slots * step.n_bins, np.arange(len(at))
    for j in range(k):
        same = (features[:, j] == features[0, j]).all()
        place = base + (bins[:, features[0, j]] if same else bins[rows, features[slots, j]])
        for c, s in enumerate(sums):
            out[c, :, j] = np.bincount(place, s, n * step.n_bins).reshape(n, -1)
    return out.reshape(len(sums), -1)


# -- splitting ------------------------------------------------------------------------------------------------
def _soft(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0) if l1 else g


def _gains(plan: TreePlan, left: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Gain of sending ``left`` (channels first) out of ``total`` to the left; -inf where not allowed."""
    right = total - left
    n_left, n_right = left[0], right[0]
    ok = (n_left >= max(1, plan.min_leaf)) & (n_right >= max(1, plan.min_leaf))
    with np.errstate(divide="ignore", invalid="ignore"):
        if plan.criterion == "gini":
            score = lambda s: (s[1].astype(float) ** 2 + (s[0] - s[1]).astype(float) ** 2) / s[0]
            gain = score(left) + score(right) - score(total)
            least = max(plan.min_gain * 1.0, 1e-9)
        elif plan.criterion == "variance":
            gl, gr = left[1] / UNIT, right[1] / UNIT
            gain = n_left * n_right / (n_left + n_right).astype(float) * (gl / n_left - gr / n_right) ** 2
            least = max(plan.min_gain, 1e-12)
        else:
            score = lambda s: _soft(s[1] / UNIT, plan.l1) ** 2 / (s[2] / UNIT + plan.l2)
            gain = 0.5 * (score(left) + score(right) - score(total)) - plan.min_gain
            ok &= (left[2] >= plan.min_hessian * UNIT) & (right[2] >= plan.min_hessian * UNIT)
            least = 1e-12
    return np.where(ok & np.isfinite(gain) & (gain > least), gain, -np.inf)


def best_splits(plan: TreePlan, features: np.ndarray, h: np.ndarray) -> dict[str, np.ndarray]:
    """Best split of each node from its histograms ``h`` (channels, slots, features, bins); of equal gains the first
    feature and bin. ``cut`` is -1 without an allowed split."""
    total = h[:, :, 0, :].sum(axis=2)
    nulls, cum = h[:, :, :, :1], np.cumsum(h[:, :, :, 1:], axis=3)[:, :, :, :-1]
    wide = total[:, :, None, None]
    gains = [_gains(plan, cum, wide)]
    if nulls[0].any():
        gains.append(_gains(plan, cum + nulls, wide))
    stacked = np.stack(gains, axis=2)  # slots, features, nulls left, cuts
    flat = stacked.reshape(len(total[0]), -1)
    at = flat.argmax(axis=1)
    gain = flat[np.arange(len(flat)), at]
    f, side, cut = np.unravel_index(at, stacked.shape[1:])
    s = np.arange(len(flat))
    left = cum[:, s, f, cut] + np.where(side == 1, nulls[:, s, f, 0], 0)
    found = np.isfinite(gain)
    if plan.criterion == "gini":
        found &= (total[1] > 0) & (total[1] < total[0])
    found &= total[0] >= plan.min_split
    return {"feature": features[s, f], "cut": np.where(found, cut + 1, -1), "null_left": side == 1, "gain": np.where(found, gain, 0.0),
            "left": left.T, "total": total.T}


_HISTOGRAM = "tree int, cells binary, sums binary"
_RESULT = "tree int, feature binary, cut binary, null_left binary, gain binary, left_stats binary, total binary"


#: Histogram cells that are worth a task of their own, and (row, tree) pairs that are.
CELLS_PER_TASK, PAIRS_PER_TASK = 200_000, 100_000


def _sizes(step: Step) -> Iterator[tuple[int, int]]:
    """(channels, cells) of each tree's histogram."""
    for t, plan in enumerate(step.plans):
        if step.count(t):
            yield plan.channels, step.count(t) * step.features(t).shape[1] * step.n_bins


def find_splits(packed: Packed, state: DataFrame, step: Step, gradients_of: Callable | None) -> dict[str, np.ndarray]:
    """One Spark job: histograms of all waiting nodes, shuffled by tree, to the best split of each node.

    What reaches the driver is one split per waiting node; its size depends on the trees, not on the rows."""
    spark = state.sparkSession
    shared = spark.sparkContext.broadcast((step, gradients_of))  # trees and settings; bounded by the models' sizes
    splits, d = packed.splits, len(packed.features)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, gradients_of = shared.value
        plans = step.plans
        # trees that draw alike follow one another: rows are drawn once for them
        waiting = sorted((t for t in range(len(plans)) if step.count(t)), key=lambda t: _draw(plans[t]))
        for batch in one_by_one(batches):
            own = cells_of(batch, splits, d)
            of_model = gradients_of(batch, own) if gradients_of else None
            out, size, last, times = [], 0, None, None
            for t in waiting:
                if last != _draw(plans[t]):
                    last, times = _draw(plans[t]), drawn(own, plans[t])
                h = histogram(own, step, t, of_model(plans[t].model) if of_model else None, times)
                if h is not None:
                    out.append((t, *_encode(h)))
                    size += len(out[-1][2])
                if size > 16_000_000:
                    yield _rows(out)
                    out, size = [], 0
            if out:
                yield _rows(out)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, _ = shared.value
        current, total = -1, None

        def done() -> pa.RecordBatch:
            plan, features = step.plans[current], step.features(current)
            h = total.reshape(plan.channels, step.count(current), features.shape[1], step.n_bins)
            b = best_splits(plan, features, h)
            cols = [b["feature"].astype(np.int16), b["cut"].astype(np.int16), b["null_left"].astype(bool), b["gain"].astype(float),
                    b["left"].astype(np.int64), b["total"].astype(np.int64)]
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), *(pa.array([np.ascontiguousarray(c).tobytes()]) for c in cols)],
                                              names=["tree", "feature", "cut", "null_left", "gain", "left_stats", "total"])

        for batch in batches:
            trees = batch.column(0).to_numpy()
            for i, t in enumerate(trees):
                if t != current:
                    if total is not None:
                        yield done()
                    current = int(t)
                    size = step.count(current) * step.features(current).shape[1] * step.n_bins
                    total = np.zeros((step.plans[current].channels, size), dtype=np.int64)
                sums = np.frombuffer(batch.column(2)[i].as_buffer(), dtype=np.int64).reshape(len(total), -1)
                if sums.shape[1] == total.shape[1]:
                    total += sums
                else:
                    total[:, np.frombuffer(batch.column(1)[i].as_buffer(), dtype=np.int32)] += sums
        if total is not None:
            yield done()

    trees = int((np.diff(step.first) > 0).sum())
    cells = sum(c * n for c, n in _sizes(step))
    parts = max(1, min(trees, cells // CELLS_PER_TASK))
    tasks = max(1, min(packed.n_parts, packed.n_rows * trees // PAIRS_PER_TASK))
    names = [*CELL_COLUMNS, *(c for c in ROW_COLUMNS if any(p.bootstrap or p.subsample < 1.0 for p in step.plans)), *(c for c in ("margins",) if c in state.columns)]
    merged = (state.select(*names).coalesce(tasks).mapInArrow(count, _HISTOGRAM).repartition(parts, "tree").sortWithinPartitions("tree").mapInArrow(merge, _RESULT))
    n = len(step.nodes)
    out = {"feature": np.zeros(n, np.int16), "cut": np.full(n, -1, np.int16), "null_left": np.zeros(n, bool), "gain": np.zeros(n),
           "left_stats": np.zeros((n, 3), np.int64), "total": np.zeros((n, 3), np.int64)}
    for row in merged.collect():
        at = slice(int(step.first[row["tree"]]), int(step.first[row["tree"] + 1]))
        for name in ("feature", "cut", "null_left", "gain"):
            out[name][at] = np.frombuffer(row[name], dtype=out[name].dtype)
        for name in ("left_stats", "total"):
            wide = np.frombuffer(row[name], dtype=np.int64).reshape(at.stop - at.start, -1)
            out[name][at, :wide.shape[1]] = wide
    shared.unpersist()
    return out


def with_batch(batches: Iterator[pa.RecordBatch], splits: list[str], n_features: int):
    """(batch of one block, its arrays), so that a task's other columns stay at hand."""
    for one in one_by_one(batches):
        yield one, next(unpacked(iter([one]), splits, n_features))


def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1)


def _rows(out: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    t, c, s = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(c, pa.binary()), pa.array(s, pa.binary())], names=["tree", "cells", "sums"])


# -- growing --------------------------------------------------------------------------------------------------
def _step(forest: Forest, nodes: np.ndarray, n_bins: int) -> Step:
    nodes = nodes[np.argsort(forest.tree[nodes], kind="stable")]
    slot = np.full(len(forest.tree), -1, dtype=np.int64)
    slot[nodes] = np.arange(len(nodes))
    first = np.searchsorted(forest.tree[nodes], np.arange(len(forest.plans) + 1))
    return Step(forest.plans, forest.routes(), nodes, slot, first, _candidates(forest, nodes), n_bins)


def grow(packed: Packed, state: DataFrame, plans: list[TreePlan], gradients_of: Callable | None = None) -> Forest:
    """Grows all trees; one job a step, whatever the number of trees."""
    return grown(plans, packed.n_bins, lambda step: find_splits(packed, state, step, gradients_of))


def grown(plans: list[TreePlan], n_bins: int, find: Callable[[Step], dict[str, np.ndarray]]) -> Forest:
    """Grows all trees; ``find`` gives the best splits of a step's nodes."""
    forest = Forest.roots(plans)
    depth_limit = np.array([p.max_depth for p in plans])
    least = np.array([max(p.min_split, 2 * p.min_leaf, 2) for p in plans])
    by_best = [t for t, p in enumerate(plans) if p.leaves]
    level_wise = np.array([not p.leaves for p in plans])
    best: dict[int, dict[int, tuple]] = {t: {} for t in by_best}
    waiting = np.flatnonzero(depth_limit > 0)
    root = True
    while len(waiting):
        step = _step(forest, waiting, n_bins)
        found = find(step)
        if root:
            forest.stats[step.nodes] = found["total"]
            root = False
        trees = forest.tree[step.nodes]
        take = (found["cut"] >= 0) & level_wise[trees]
        made = [_split(forest, step.nodes[take], found, take)]
        for t in by_best:
            for i in range(int(step.first[t]), int(step.first[t + 1])):
                if found["cut"][i] >= 0:
                    best[t][int(step.nodes[i])] = tuple(found[c][i] for c in ("feature", "cut", "null_left", "gain", "left_stats"))
            made.append(_expand(forest, t, best[t]))
        new = np.concatenate(made)
        tree = forest.tree[new]
        waiting = new[(forest.depth[new] < depth_limit[tree]) & (forest.stats[new, 0] >= least[tree])]
    for t in by_best:
        _prune(forest, t, best[t])
    return forest


def _split(forest: Forest, nodes: np.ndarray, found: dict, take: np.ndarray) -> np.ndarray:
    return forest.split(nodes, found["feature"][take], found["cut"][take], found["null_left"][take], found["gain"][take],
                        found["left_stats"][take]) if len(nodes) else np.zeros(0, np.int64)


def best_first(forest: Forest, t: int, best: dict[int, tuple]) -> list[int]:
    """Nodes that best-first growth splits with the splits known so far: always the leaf of the largest gain, of equal
    gains the earlier one, until the tree has all its leaves."""
    queue = [(-best[t][3], int(forest.path[t]), t)] if t in best else []
    chosen: list[int] = []
    while queue and len(chosen) < forest.plans[t].leaves - 1:
        _, _, node = heapq.heappop(queue)
        chosen.append(node)
        if forest.left[node] >= 0:
            for child in (int(forest.left[node]), int(forest.left[node]) + 1):
                if child in best:
                    heapq.heappush(queue, (-best[child][3], int(forest.path[child]), child))
    return chosen


def _expand(forest: Forest, t: int, best: dict[int, tuple]) -> np.ndarray:
    """Gives children to the chosen nodes that have none yet; their splits are looked for next."""
    nodes = [n for n in best_first(forest, t, best) if forest.left[n] < 0]
    if not nodes:
        return np.zeros(0, np.int64)
    cols = [np.array(c) for c in zip(*(best[n] for n in nodes), strict=True)]
    return forest.split(np.array(nodes), *cols)


def _prune(forest: Forest, t: int, best: dict[int, tuple]) -> None:
    """Nodes that the final queue does not choose are leaves."""
    keep = np.zeros(len(forest.tree), dtype=bool)
    keep[best_first(forest, t, best)] = True
    own = (forest.tree == t) & ~keep
    forest.cut[own] = -1
    forest.gain[own] = 0.0
