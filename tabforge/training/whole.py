"""Whole trees and whole boosted models grown inside a task.

Trees read bins alone, so rows of equal bins are one entry to them, with numbers of rows by label
and by what is held out. Where these entries are few enough (``CELLS_IN_A_TASK``, ``ENTRIES_IN_A_TASK``),
all tasks get their table and grow models from root to leaves, or through all rounds, without a
job a level. All rows count: the table is made of all of them, and rows that are drawn are drawn
within the blocks, by their keys. Frames of more entries are counted level by level (``trees.find_splits``).

Both ways give the same trees: sums are whole numbers, and the steps are those of ``trees.grown``.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tabforge.training.blocks import CELL_COLUMNS, ROW_COLUMNS, Condition, Packed, _trains, cells_of
from tabforge.training.trees import UNIT, Forest, Routes, Step, TreePlan, best_splits, drawn, grown, one_by_one

#: Cells (equal bins, splits and label) and entries (equal bins) up to which a frame's table goes to the tasks: about 6 bytes a
#: cell and one a feature and entry, and in a task some 30 bytes a cell and 100 an entry.
CELLS_IN_A_TASK, ENTRIES_IN_A_TASK = 12_000_000, 2_000_000
#: Bytes of drawn numbers that go to the tasks at once.
DRAWN_AT_ONCE = 64_000_000
#: Tasks a core for trees; they differ in size.
TASKS_PER_CORE = 6
#: Rows from which sums of gradients are added up in two halves: a float holds whole numbers below 2**53 only.
EXACT_ROWS = 1 << 22
#: Shift of the rows of label 1 where both counts are added up in one float.
BOTH = 26


def _small(x: np.ndarray) -> np.ndarray:
    """``x`` in the shortest unsigned type that holds it."""
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


@dataclass
class View:
    """Entries by some of the features: a row of ``columns`` a feature, ``place`` says which; ``of`` is 2 * entry + label of each cell."""

    columns: np.ndarray
    place: np.ndarray
    of: np.ndarray

    def __len__(self) -> int:
        return self.columns.shape[1]


@dataclass
class Table:
    """The cells of a frame: ``of`` is the entry, ``combo`` the splits and label of each."""

    bins: np.ndarray
    of: np.ndarray
    combo: np.ndarray
    counts: np.ndarray
    labels: np.ndarray
    splits: dict[str, np.ndarray]
    n_bins: int

    def trains(self, conditions: Sequence[Condition]) -> np.ndarray:
        return _trains(self.splits, len(self.labels), conditions)

    def label_counts(self, conditions: Sequence[tuple[Condition, ...]]) -> np.ndarray:
        """(rows, rows of label 1) that remain under each of the conditions."""
        rows = np.bincount(self.combo, self.counts, len(self.labels)).astype(np.int64)
        return np.array([[(rows * on).sum(), (rows * on * self.labels).sum()] for on in map(self.trains, conditions)], dtype=np.int64)

    def view(self, features: Sequence[int]) -> View:
        first, entry = _distinct(self.bins[:, list(features)], self.n_bins)
        place = np.full(self.bins.shape[1], -1, dtype=np.int64)
        place[list(features)] = np.arange(len(features))
        return View(np.ascontiguousarray(self.bins[first][:, list(features)].T), place, entry[self.of] * 2 + self.labels[self.combo])

    def rows(self, view: View, conditions: Sequence[Condition], times: np.ndarray | None = None) -> np.ndarray:
        """(entries, 2): rows of label 0 and 1, each cell counted ``times``."""
        on = self.trains(conditions)
        w = self.counts if times is None else times
        return np.bincount(view.of, w if on.all() else w * on[self.combo], 2 * len(view)).astype(np.int64).reshape(-1, 2)


def _distinct(bins: np.ndarray, n_bins: int) -> tuple[np.ndarray, np.ndarray]:
    """(first position, number of each row) of the distinct rows, in the order of their values."""
    d = bins.shape[1]
    if d * np.log2(n_bins) < 63:
        code = np.zeros(len(bins), dtype=np.int64)
        for j in range(d):
            code = code * n_bins + bins[:, j]
    else:
        code = np.ascontiguousarray(bins).view(np.dtype((np.void, d))).ravel()
    _, first, inverse = np.unique(code, return_index=True, return_inverse=True)
    return first, inverse.astype(np.int64)


_TABLE = "block long, bins binary, runs binary, combos binary, combo binary, counts binary, widths array<int>"


def table_of(packed: Packed) -> Table | None:
    """The table of a frame, or nothing where it has too many cells or entries. Made once a frame."""
    if packed.table is None:
        packed.table = _table_of(packed) or False
    return packed.table or None


def _table_of(packed: Packed) -> Table | None:
    if (packed.frame.agg(F.sum(F.length("cell_labels")).alias("n")).first()["n"] or 0) > CELLS_IN_A_TASK:
        return None
    splits, d = packed.splits, len(packed.features)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            own = cells_of(batch, splits, d)
            # cells are ordered by their bins, those of an entry follow one another
            new = np.flatnonzero(np.concatenate([[True], (own.bins[1:] != own.bins[:-1]).any(axis=1)]))
            both = np.column_stack([*(own.splits[c] for c in splits), own.labels]).astype(np.int32)
            combos, combo = np.unique(both, axis=0, return_inverse=True)
            arrays = [_small(np.diff(np.append(new, len(own)))), _small(combo.ravel()), _small(own.counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("block")), *(pa.array([x.tobytes()]) for x in (own.bins[new], arrays[0], np.ascontiguousarray(combos), *arrays[1:])),
                 pa.array([[x.itemsize for x in arrays]], pa.list_(pa.int32()))], names=["block", "bins", "runs", "combos", "combo", "counts", "widths"])

    bins, of, combo, counts, found, entries = [], [], [], [], {}, 0
    for r in sorted(packed.frame.select("block", *CELL_COLUMNS).mapInArrow(work, _TABLE).collect(), key=lambda r: r["block"]):  # bounded by CELLS_IN_A_TASK
        runs, own, n = (np.frombuffer(r[c], np.dtype(f"u{w}")) for c, w in zip(("runs", "combo", "counts"), r["widths"], strict=True))
        named = [found.setdefault(tuple(c), len(found)) for c in np.frombuffer(r["combos"], np.int32).reshape(-1, len(splits) + 1).tolist()]
        bins.append(np.frombuffer(r["bins"], np.uint8).reshape(-1, d))
        of.append(np.repeat(np.arange(entries, entries + len(runs), dtype=np.int64), runs))
        combo.append(np.array(named, dtype=np.int32)[own])
        counts.append(n.astype(np.int64))
        entries += len(runs)
    if not bins:
        return None
    every = np.concatenate(bins)
    first, entry = _distinct(every, packed.n_bins)
    if len(first) > ENTRIES_IN_A_TASK:
        return None
    combos = np.array(list(found), dtype=np.int32).reshape(len(found), -1)
    return Table(every[first], entry[np.concatenate(of)].astype(np.int32), _small(np.concatenate(combo)), _small(np.concatenate(counts)),
                 combos[:, -1].astype(np.int64), {c: combos[:, j] for j, c in enumerate(splits)}, packed.n_bins)


def draws(packed: Packed, plans: Sequence[TreePlan]) -> list[np.ndarray]:
    """How often each cell of the table is drawn for each of the plans."""
    splits, d = packed.splits, len(packed.features)
    shared = packed.frame.sparkSession.sparkContext.broadcast(list(plans))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            own, block = cells_of(batch, splits, d), batch.column(batch.schema.get_field_index("block"))
            for i, plan in enumerate(shared.value):
                times = _small(drawn(own, plan))
                yield pa.RecordBatch.from_arrays([block, pa.array([i], pa.int32()), pa.array([times.itemsize], pa.int32()), pa.array([times.tobytes()])],
                                                 names=["block", "i", "width", "times"])

    parts: dict[int, list] = {i: [] for i in range(len(plans))}
    frame = packed.frame.select("block", *CELL_COLUMNS, *ROW_COLUMNS).mapInArrow(work, "block long, i int, width int, times binary")
    for r in sorted(frame.collect(), key=lambda r: r["block"]):  # bounded by DRAWN_AT_ONCE
        parts[r["i"]].append(np.frombuffer(r["times"], np.dtype(f"u{r['width']}")))
    shared.unpersist()
    return [np.concatenate(p) for p in parts.values()]


class Finder:
    """Finds the splits of one tree among the entries that its rows are in. ``sums``: rows, and rows of label 1 or sums
    of gradients and Hessians, of each entry."""

    def __init__(self, columns: np.ndarray, place: np.ndarray, n_bins: int, sums: Sequence[np.ndarray], criterion: str):
        self.columns, self.place, self.n_bins, self.criterion = np.ascontiguousarray(columns), place, n_bins, criterion
        self.flat, self.node = self.columns.reshape(-1), np.zeros(columns.shape[1], dtype=np.int64)
        self.sums, self.n = sums, int(sums[0].sum())
        self.drawn = None if (sums[0] > 0).all() else sums[0] > 0
        self.channels = self._channels()

    def _channels(self) -> list[tuple[np.ndarray, Callable]]:
        """What is added up, and what makes whole sums of it."""
        whole = lambda x: x.astype(np.int64)
        n, second = self.sums[0], self.sums[1]
        if self.criterion == "gini":
            if self.n < 1 << BOTH:
                return [((n + (second << BOTH)).astype(np.float64), whole)]
            return [(n.astype(np.float64), whole), (second.astype(np.float64), whole)]
        out = [(n.astype(np.float64), whole)]
        # variance gains do without Hessians: these are added up for the chosen splits alone
        for s in self.sums[1:] if self.criterion == "newton" else self.sums[1:2]:
            if self.n < EXACT_ROWS:
                out.append((s.astype(np.float64), whole))
            else:
                out += [((s >> 20).astype(np.float64), lambda x: x.astype(np.int64) << 20), ((s & 0xFFFFF).astype(np.float64), None)]
        return out

    def _added(self, place: np.ndarray, channels: Sequence[np.ndarray], size: int) -> list[np.ndarray]:
        """Whole sums of ``channels`` (those of the entries in question) by place."""
        out: list[np.ndarray] = []
        for s, (_, whole) in zip(channels, self.channels, strict=True):
            x = np.bincount(place, s, size)
            if whole is None:
                out[-1] += x.astype(np.int64)
            else:
                out.append(whole(x))
        if self.criterion == "gini" and len(out) == 1:
            return [out[0] & ((1 << BOTH) - 1), out[0] >> BOTH]
        return out

    def descend(self, routes: Routes) -> None:
        """Moves the entries to the leaves of the tree so far."""
        rows = np.flatnonzero(routes.cut[self.node] >= 0)
        m = self.columns.shape[1]
        while len(rows):
            at = self.node[rows]
            b = self.flat.take(self.place[routes.feature[at]] * m + rows)
            right = np.where(b == 0, ~routes.null_left[at], b > routes.cut[at])
            at = routes.left[at] + right
            self.node[rows] = at
            rows = rows[routes.cut[at] >= 0]

    def __call__(self, step: Step) -> dict[str, np.ndarray]:
        plan, n, features = step.plans[0], step.count(0), step.features(0)
        self.descend(step.routes)
        slots = step.slot[self.node]
        inside = slots >= 0
        if self.drawn is not None:
            inside &= self.drawn
        at = None if inside.all() else np.flatnonzero(inside)
        if at is not None:
            slots = slots[at]
        m, k = self.columns.shape[1], features.shape[1]
        rows = np.arange(m) if at is None else at
        base = slots * self.n_bins
        channels = [np.empty((n, k, self.n_bins), dtype=np.int64) for _ in range(2 if self.criterion in ("gini", "variance") else 3)]
        same = (features == features[0]).all(axis=0)
        own = [s if at is None else s[at] for s, _ in self.channels]
        for j in range(k):
            if same[j]:
                b = self.columns[self.place[features[0, j]]]
                b = b if at is None else b[at]
            else:
                b = self.flat.take((self.place[features[:, j]] * m)[slots] + rows)
            for c, x in enumerate(self._added(base + b, own, n * self.n_bins)):
                channels[c][:, j] = x.reshape(n, -1)
        found = best_splits(plan, features, np.stack(channels))
        left, total = np.zeros((n, 3), np.int64), np.zeros((n, 3), np.int64)
        left[:, :len(channels)], total[:, :len(channels)] = found["left"], found["total"]
        if self.criterion == "variance":
            b = self.flat.take((self.place[found["feature"]] * m)[slots] + rows)
            goes = np.where(b == 0, found["null_left"][slots], b <= found["cut"][slots])
            h = self.sums[2][rows]
            total[:, 2], left[:, 2] = _whole_sums(slots, h, n, self.n), _whole_sums(slots[goes], h[goes], n, self.n)
        return {"feature": found["feature"].astype(np.int16), "cut": found["cut"].astype(np.int16), "null_left": found["null_left"], "gain": found["gain"],
                "left_stats": left, "total": total}


def _whole_sums(place: np.ndarray, s: np.ndarray, size: int, rows: int) -> np.ndarray:
    if rows < EXACT_ROWS:
        return np.bincount(place, s, size).astype(np.int64)
    return (np.bincount(place, s >> 20, size).astype(np.int64) << 20) + np.bincount(place, s & 0xFFFFF, size).astype(np.int64)


def _run(packed: Packed, n: int, shared: tuple, work: Callable, tasks: int) -> list:
    """What ``work`` makes of the frame's table and ``shared`` for each number below ``n``; a task has several."""
    spark = packed.frame.sparkSession
    if packed.sent is None:
        packed.sent = spark.sparkContext.broadcast(table_of(packed))  # bounded by CELLS_IN_A_TASK; once a frame
    table, held, tasks = packed.sent, spark.sparkContext.broadcast(shared), max(1, min(n, tasks))

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in batch.column(0).to_pylist():
                for i, made in work(table.value, *held.value, range(first, n, tasks)):
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([pickle.dumps(made)])], names=["i", "made"])

    rows = spark.range(0, tasks, 1, tasks).mapInArrow(of_task, "i int, made binary").collect()  # bounded by the models' sizes
    held.unpersist()
    return [pickle.loads(r["made"]) for r in sorted(rows, key=lambda r: r["i"])]


def _key(plan: TreePlan) -> tuple | None:
    """What a plan's drawing of rows depends on; nothing where all rows count."""
    return (plan.seed, plan.bootstrap, plan.subsample) if plan.bootstrap or plan.subsample < 1.0 else None


def _batches(keys: Sequence, size: int) -> Iterator[list]:
    most = max(1, DRAWN_AT_ONCE // max(1, size))
    for at in range(0, len(keys), most):
        yield list(keys[at:at + most])


def grow_trees(packed: Packed, table: Table, plans: Sequence[TreePlan]) -> list[Forest]:
    """A forest of one tree for each plan of counted labels."""
    cores = packed.frame.sparkSession.sparkContext.defaultParallelism
    out: list[Forest | None] = [None] * len(plans)
    by_draw: dict = {}
    for t, p in enumerate(plans):
        by_draw.setdefault(_key(p), []).append(t)
    keys = sorted(by_draw, key=lambda k: (k is not None, k))
    for some in _batches(keys, len(table.of)):
        own = [k for k in some if k is not None]
        times = dict(zip(own, draws(packed, [plans[by_draw[k][0]] for k in own]), strict=True)) if own else {}
        todo = [t for k in some for t in by_draw[k]]
        # the larger trees first and spread over the tasks
        todo.sort(key=lambda t: -plans[t].max_depth * (plans[t].node_features or len(plans[t].allowed)))
        made = _run(packed, len(todo), ([plans[t] for t in todo], times), _grown_trees, TASKS_PER_CORE * cores)
        for t, arrays in zip(todo, made, strict=True):
            out[t] = Forest([plans[t]], *arrays)
    return out


def _grown_trees(table: Table, plans: Sequence[TreePlan], times: dict, which: Sequence[int]) -> Iterator[tuple[int, tuple]]:
    views: dict[tuple, View] = {}
    for i in which:
        plan = plans[i]
        if plan.allowed not in views:
            views = {plan.allowed: table.view(plan.allowed)}
        view = views[plan.allowed]
        rows = table.rows(view, plan.conditions, times.get(_key(plan)))
        n = rows.sum(axis=1)
        at = np.flatnonzero(n)
        forest = grown([plan], table.n_bins, Finder(view.columns[:, at], view.place, table.n_bins, [n[at], rows[at, 1]], plan.criterion))
        yield i, _arrays(forest)


def _arrays(f: Forest) -> tuple:
    return f.tree, f.depth, f.path, f.feature, f.cut, f.null_left, f.left, f.gain, f.stats


@dataclass
class Boosting:
    """A boosted model to grow: the plans of its rounds, its start, its learning rate, and its trees so far with their leaf values."""

    plans: list[TreePlan]
    start: float
    rate: float
    trees: list[tuple[Routes, np.ndarray]]


def grow_boosted(packed: Packed, table: Table, models: Sequence[Boosting], leaf_values: Callable) -> list[list[tuple[Forest, np.ndarray]]]:
    """(tree, leaf values) of each round of each model."""
    out: list[list] = [[] for _ in models]
    whole = [k for k, m in enumerate(models) if all(_key(p) is None for p in m.plans)]
    _rounds(packed, models, whole, 0, None, {}, leaf_values, out)
    sampled = [k for k in range(len(models)) if k not in set(whole)]
    last = max((len(models[k].plans) for k in sampled), default=0)
    first = 0
    while first < last:  # as many rounds as their drawn numbers allow
        plans, end = {}, first
        while end < last:
            more = {_key(m.plans[end]): m.plans[end] for m in (models[k] for k in sampled) if end < len(m.plans) and _key(m.plans[end]) is not None}
            if plans and (len(plans) + len(more)) * len(table.of) > DRAWN_AT_ONCE:
                break
            plans |= more
            end += 1
        times = dict(zip(plans, draws(packed, list(plans.values())), strict=True))
        _rounds(packed, models, sampled, first, end, times, leaf_values, out)
        first = end
    return out


def _rounds(packed: Packed, models: Sequence[Boosting], which: list[int], first: int, end: int | None, times: dict, leaf_values: Callable,
            out: list[list]) -> None:
    which = sorted((k for k in which if first < len(models[k].plans)), key=lambda k: -len(models[k].plans) * len(models[k].plans[0].allowed))
    if not which:
        return
    made = _run(packed, len(which), ([models[k] for k in which], times, leaf_values, first, end), _grown_rounds, len(which))
    for k, trees in zip(which, made, strict=True):
        for plan, (arrays, values) in zip(models[k].plans[first:end], trees, strict=True):
            forest = Forest([plan], *arrays)
            out[k].append((forest, values))
            models[k].trees.append((forest.routes(), values))


def _grown_rounds(table: Table, models: Sequence[Boosting], times: dict, leaf_values: Callable, first: int, end: int | None,
                  which: Sequence[int]) -> Iterator[tuple[int, list]]:
    from tabforge.training.fits import sigmoid

    for i in which:
        model = models[i]
        view = table.view(model.plans[0].allowed)
        rows = table.rows(view, model.plans[0].conditions)
        at = np.flatnonzero(rows.any(axis=1))
        columns, rows = np.ascontiguousarray(view.columns[:, at]), rows[at]
        margins = np.full(len(at), model.start)
        for routes, values in model.trees:
            finder = Finder(columns, view.place, table.n_bins, [np.ones(len(at), np.int64)] * 3, "variance")
            finder.descend(routes)
            margins += values[finder.node]
        made = []
        for plan in model.plans[first:end]:
            own = rows if _key(plan) is None else table.rows(view, plan.conditions, times[_key(plan)])[at]
            p = sigmoid(margins)
            g0, g1 = (np.rint((p - y) * UNIT).astype(np.int64) for y in (0, 1))
            h = np.rint(np.maximum(p * (1.0 - p), 1e-9) * UNIT).astype(np.int64)
            n = own[:, 0] + own[:, 1]
            finder = Finder(columns, view.place, table.n_bins, [n, own[:, 0] * g0 + own[:, 1] * g1, n * h], plan.criterion)
            forest = grown([plan], table.n_bins, finder)
            values = leaf_values([plan], forest, [model.rate])
            finder.node[:] = 0  # pruned trees have leaves above the last nodes
            finder.descend(forest.routes())
            margins += values[finder.node]
            made.append((_arrays(forest), values))
        yield i, made


def hits(packed: Packed, fits: Sequence, models: Sequence) -> list[tuple[int, int]]:
    """(rows, rows whose label it hits) of each tree model on the rows that its fit holds out (all rows without conditions)."""
    cores = packed.frame.sparkSession.sparkContext.defaultParallelism
    return _run(packed, len(fits), (list(fits), list(models)), _hits, TASKS_PER_CORE * cores)


def _hits(table: Table, fits: Sequence, models: Sequence, which: Sequence[int]) -> Iterator[tuple[int, tuple[int, int]]]:
    for i in which:
        conditions = fits[i].conditions
        on = table.trains(conditions[:-1])
        if conditions:
            on &= table.splits[conditions[-1][0]] == conditions[-1][1]
        rows = np.bincount(table.of * np.int64(2) + table.labels[table.combo], table.counts * on[table.combo], 2 * len(table.bins)).astype(np.int64).reshape(-1, 2)
        at = np.flatnonzero(rows.any(axis=1))
        ones = ~(models[i].proba_of_bins(table.bins[at]) < 0.5)
        yield i, (int(rows.sum()), int(rows[at[ones], 1].sum() + rows[at[~ones], 0].sum()))
