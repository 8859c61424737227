"""Fitting many models at once: configurations, folds and the fit on all rows side by side.

A ``Fit`` is a configuration with the conditions that hold rows out. All forests
of a call grow together, all boosted models go through their rounds together,
all linear models share each Newton step; the driver's loop is over steps,
never over models, folds or rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.operators.folds import stratified_folds
from tabforge.operators.models import ModelSpec, cv_summary, rff_weights
from tabforge.session import cut_lineage
from tabforge.training.blocks import CELL_COLUMNS, RAW_COLUMNS, ROW_COLUMNS, Block, Cells, Condition, Packed, bin_codes, cells_of, pack, seed_of, shared_pack
from tabforge.training.trees import UNIT, Forest, Routes, TreePlan, grow, one_by_one, with_batch
from tabforge.training.whole import Boosting, Table, grow_boosted, grow_trees, hits, table_of

#: Trees that grow in one go; more are grown in turns, which bounds what is shipped.
TREES_AT_ONCE = 8_192
#: Boosting rounds after which the margins are written; in between each round's are kept in memory, with the round before as their source.
ROUNDS_PER_STATE = 10
#: Rows that linear models take at once; their products of columns then stay in a core's cache.
CHUNK_ROWS = 4_096
#: Rows on which linear models of large frames find their start; all rows then need the last steps alone.
START_ROWS = 131_072
#: Times ``START_ROWS`` from which a frame is large.
LARGE = 8


@dataclass(frozen=True)
class Fit:
    """A model to fit: ``features`` are positions in the packed frame."""

    spec: ModelSpec
    features: tuple[int, ...]
    conditions: tuple[Condition, ...] = ()
    seed: int = 42


# -- predicting -----------------------------------------------------------------------------------------------
@dataclass
class TreeModel:
    """Trees with leaf values: their mean (``mean``) or the logistic of start + sum."""

    routes: Routes
    roots: list[int]
    values: np.ndarray
    mean: bool
    start: float = 0.0

    def sums(self, bins: np.ndarray) -> np.ndarray:
        out, last, of_tree = np.zeros(len(bins)), None, None
        for root in self.roots:
            if root != last:  # equal trees follow one another
                last, of_tree = root, self.values[self.routes.leaf_of(root, bins)]
            out += of_tree
        return out

    def raw(self, block: Block, rows: np.ndarray) -> np.ndarray:
        bins, of = block.entries
        own = of[rows]
        used = np.flatnonzero(np.bincount(own, minlength=len(bins)))
        place = np.zeros(len(bins), dtype=np.int64)
        place[used] = np.arange(len(used))
        return self.sums(bins[used])[place[own]]

    def proba(self, block: Block, rows: np.ndarray) -> np.ndarray:
        return self._proba(self.raw(block, rows))

    def proba_of(self, raw: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
        """Of rows outside the packed frame."""
        return self.proba_of_bins(bin_codes(raw, edges))

    def proba_of_bins(self, bins: np.ndarray) -> np.ndarray:
        return self._proba(self.sums(bins))

    def _proba(self, s: np.ndarray) -> np.ndarray:
        return s / max(1, len(self.roots)) if self.mean else sigmoid(self.start + s)


@dataclass
class FourierMap:
    """Standardised features to random Fourier features of the RBF kernel."""

    features: tuple[int, ...]
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        x = (raw[:, self.features] - self.mean) / self.scale
        return math.sqrt(2.0 / len(self.phases)) * np.cos(x @ self.directions.T + self.phases)


@dataclass
class LinearModel:
    features: tuple[int, ...]
    weights: np.ndarray
    map: FourierMap | None = None

    def proba(self, block: Block, rows: np.ndarray) -> np.ndarray:
        x = self.map(block.raw[rows]) if self.map else block.raw[np.ix_(rows, self.features)]
        return sigmoid(x @ self.weights[:-1] + self.weights[-1])


@dataclass
class Fitted:
    """Models in the order of their fits."""

    fits: list[Fit]
    models: list
    gains: dict[int, np.ndarray] = field(default_factory=dict)
    shares: dict[int, np.ndarray] = field(default_factory=dict)

    def importances(self, i: int, n_features: int) -> np.ndarray:
        """Of tree models: gains by feature, in a forest as shares of each tree's gains; they sum to 1 (0 without a split)."""
        total = self.shares.get(i, self.gains.get(i, np.zeros(n_features)))
        return total / total.sum() if total.sum() > 0 else total


def sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + np.exp(-x))


def predictions(packed: Packed, fitted: Fitted, everywhere: bool = False) -> DataFrame:
    """id, fit (position), label, proba: each fit on the rows it holds out (fits without conditions: on all rows), or on
    all rows of ``packed``."""
    shared = packed.frame.sparkSession.sparkContext.broadcast((fitted.fits, fitted.models))  # bounded by the models' sizes
    splits, d, id_col = packed.splits, len(packed.features), packed.id_col

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits, models = shared.value
        for _, block in with_batch(batches, splits, d):
            for i, (fit, model) in enumerate(zip(fits, models, strict=True)):
                rows = np.arange(len(block)) if everywhere else np.flatnonzero(block.held_out(fit.conditions))
                if len(rows):
                    yield pa.RecordBatch.from_arrays(
                        [block.ids.take(pa.array(rows)), pa.array(np.full(len(rows), i, np.int32)), pa.array(block.labels[rows].astype(np.int32)),
                         pa.array(model.proba(block, rows))], names=[id_col, "fit", "label", "proba"])

    return packed.frame.mapInArrow(work, f"`{packed.id_col}` {packed.id_type}, fit int, label int, proba double")


def fit_scores(packed: Packed, fitted: Fitted, extra: Sequence[dict] | None = None) -> DataFrame:
    """model, seed, fold, columns of ``extra``, n, hits: rows that each fit predicts (as ``predictions``) and those whose label it hits.
    Counted within the blocks, or where the frame has a table those of trees on its entries; what leaves them are two numbers a fit."""
    spark = packed.frame.sparkSession
    quick = [i for i, m in enumerate(fitted.models) if packed.table and isinstance(m, TreeModel)]
    done = hits(packed, [fitted.fits[i] for i in quick], [fitted.models[i] for i in quick]) if quick else []
    known = spark.createDataFrame([(i, *x) for i, x in zip(quick, done, strict=True) if x[0]], "fit int, n long, hits long")  # one row a fit
    rest = [(i, fitted.fits[i], fitted.models[i]) for i in range(len(fitted.fits)) if i not in set(quick)]
    if not rest:
        return cut_lineage(_labelled(known, fitted.fits, extra))
    shared = spark.sparkContext.broadcast(rest)  # bounded by the models' sizes
    splits, d = packed.splits, len(packed.features)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in with_batch(batches, splits, d):
            found = []
            for i, fit, model in shared.value:
                rows = np.flatnonzero(block.held_out(fit.conditions))
                if len(rows):
                    found.append((i, len(rows), int((~(model.proba(block, rows) < 0.5) == block.labels[rows]).sum())))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.int32(), pa.int64(), pa.int64()), strict=True)],
                                                 names=["fit", "n", "hits"])

    counts = packed.frame.mapInArrow(work, "fit int, n long, hits long").groupBy("fit").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    out = cut_lineage(_labelled(counts.unionByName(known) if quick else counts, fitted.fits, extra))
    shared.unpersist()
    return out


def ballots(packed: Packed, fitted: Fitted) -> DataFrame:
    """fit, n, hits of the majority vote of all models that hold the same rows out (``fit``: the first of them). Models vote
    within the blocks; an id is one ballot, so what leaves the blocks is a row an id and held-out part, not one a model."""
    first: dict[tuple[Condition, ...], int] = {}
    groups: dict[int, list[int]] = {}
    for i, f in enumerate(fitted.fits):
        groups.setdefault(first.setdefault(f.conditions, i), []).append(i)
    shared = packed.frame.sparkSession.sparkContext.broadcast((groups, fitted.fits, fitted.models))  # bounded by the models' sizes
    splits, d, id_col = packed.splits, len(packed.features), packed.id_col

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, fits, models = shared.value
        for _, block in with_batch(batches, splits, d):
            for i, own in groups.items():
                rows = np.flatnonzero(block.held_out(fits[i].conditions))
                if len(rows):
                    yes = sum((~(models[k].proba(block, rows) < 0.5)).astype(np.int32) for k in own)
                    yield pa.RecordBatch.from_arrays(
                        [block.ids.take(pa.array(rows)), pa.array(np.full(len(rows), i, np.int32)), pa.array(block.labels[rows].astype(np.int32)),
                         pa.array(np.full(len(rows), len(own), np.int32)), pa.array(yes)], names=[id_col, "fit", "label", "cast", "yes"])

    every = packed.frame.mapInArrow(work, f"`{id_col}` {packed.id_type}, fit int, label int, cast int, yes int")
    one = every.groupBy(id_col, "fit", "label").agg((2 * F.sum("yes") > F.sum("cast")).cast("int").alias("pred"))
    return one.groupBy("fit").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("pred") == F.col("label")).cast("long")).alias("hits"))


def scores_summary(scores: DataFrame, keys: Sequence[str] = ("model",), with_train: bool = False) -> DataFrame:
    """``cv_summary`` of the counts of ``fit_scores``; the train score is that of the fits on all rows (fold -1)."""
    keys = list(keys)
    share = F.sum("hits") / F.sum("n")
    held = scores.where("fold >= 0")
    folds = held.groupBy(*keys, "fold").agg(share.alias("score"))
    out = folds.groupBy(*keys).agg(F.avg("score").alias("cv_score"), F.stddev_pop("score").alias("cv_std"))
    out = out.join(held.groupBy(*keys).agg(share.alias("oof_score")), keys)
    if with_train:
        train = scores.where("fold = -1").groupBy(*keys).agg(share.alias("train_score"))
        out = out.join(train, keys).withColumn("gap", F.col("train_score") - F.col("cv_score"))
    return out


# -- fitting --------------------------------------------------------------------------------------------------
def _label_counts(packed: Packed, conditions: list[tuple[Condition, ...]]) -> np.ndarray:
    """(rows, rows of label 1) that remain under each of the conditions."""
    splits, d = packed.splits, len(packed.features)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in with_batch(batches, splits, d):
            own = [block.trains(c) for c in conditions]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(own), dtype=np.int32)), pa.array([int(w.sum()) for w in own], pa.int64()),
                                              pa.array([int(block.labels[w].sum()) for w in own], pa.int64())], names=["c", "n", "pos"])

    out = np.zeros((len(conditions), 2), dtype=np.int64)
    for r in packed.frame.mapInArrow(work, "c int, n long, pos long").groupBy("c").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).collect():
        out[r["c"]] = r["n"], r["pos"]
    return out


def node_features(rule: str | int | float, n: int) -> int:
    """Features tried at a node; 0 for all. A fraction is a share of them."""
    if isinstance(rule, float):
        return max(1, int(rule * n))
    if rule == "sqrt":
        return max(1, int(math.sqrt(n)))
    if rule == "log2":
        return max(1, int(math.log2(n)))
    return 0 if rule in ("all", None) else int(rule)


def _forest_plans(i: int, fit: Fit) -> list[TreePlan]:
    p = fit.spec.params
    common = TreePlan(i, 0, fit.conditions, fit.features, "gini", int(p.get("max_depth", 5)), 0, int(p.get("min_samples_split", 2)),
                      int(p.get("min_samples_leaf", 1)), node_features=node_features(p.get("max_features", "sqrt"), len(fit.features)),
                      bootstrap=bool(p.get("bootstrap", True)))
    first = int(p.get("first_tree", 0))
    return [replace(common, seed=seed_of(fit.seed, "tree", k)) for k in range(first, first + int(p.get("n_trees", 50)))]


def fit_forests(packed: Packed, fits: Sequence[tuple[int, Fit]], out: Fitted) -> None:
    plans = [p for i, f in fits for p in _forest_plans(i, f)]
    table = table_of(packed)
    if table is not None:
        _forests_in_tasks(packed, table, plans, out)
        return
    parts: dict[int, list[TreeModel]] = {}
    for at in range(0, len(plans), TREES_AT_ONCE):
        own = plans[at:at + TREES_AT_ONCE]
        forest = grow(packed, packed.frame, own)
        values = forest.stats[:, 1] / np.maximum(forest.stats[:, 0], 1)
        by_feature = _tree_gains(forest, len(packed.features))
        roots: dict[int, list[int]] = {}
        for t, p in enumerate(own):
            roots.setdefault(p.model, []).append(t)
        for i, r in roots.items():
            parts.setdefault(i, []).append(TreeModel(forest.routes(), r, values, True))
            by_tree = by_feature[r]
            shares = by_tree / np.maximum(by_tree.sum(axis=1, keepdims=True), 1e-300)
            out.shares[i] = out.shares.get(i, 0.0) + shares.sum(axis=0)
            _add_gains(out, i, forest, np.isin(forest.tree, r), len(packed.features))
    for i, models in parts.items():
        out.models[i] = models[0] if len(models) == 1 else joined(models)


def _forests_in_tasks(packed: Packed, table: Table, plans: list[TreePlan], out: Fitted) -> None:
    """Each tree grown whole in a task; trees that nothing sets apart are grown once."""
    alike = [replace(p, model=0, seed=0 if p.node_features in (0, len(p.allowed)) and not p.bootstrap else p.seed) for p in plans]
    distinct = list(dict.fromkeys(alike))
    made = dict(zip(distinct, grow_trees(packed, table, distinct), strict=True))
    of: dict[int, list[TreePlan]] = {}
    for p, a in zip(plans, alike, strict=True):
        of.setdefault(p.model, []).append(a)
    for i, own in of.items():
        at, models = {}, []
        for a in dict.fromkeys(own):
            f = made[a]
            at[a] = sum(len(m.values) for m in models)
            models.append(TreeModel(f.routes(), [0], f.stats[:, 1] / np.maximum(f.stats[:, 0], 1), True))
        out.models[i] = replace(joined(models), roots=[at[a] for a in own])
        gains = np.stack([_tree_gains(made[a], len(packed.features))[0] for a in own])
        out.shares[i] = out.shares.get(i, 0.0) + (gains / np.maximum(gains.sum(axis=1, keepdims=True), 1e-300)).sum(axis=0)
        out.gains[i] = out.gains.get(i, 0.0) + gains.sum(axis=0)


def joined(models: Sequence[TreeModel]) -> TreeModel:
    """One model of the trees of several."""
    roots, values, routes, offset = [], [], [], 0
    for m in models:
        roots += [r + offset for r in m.roots]
        values.append(m.values)
        routes.append(replace(m.routes, left=np.where(m.routes.left >= 0, m.routes.left + offset, -1).astype(np.int32)))
        offset += len(m.values)
    both = Routes(*(np.concatenate([getattr(r, c) for r in routes]) for c in ("feature", "cut", "null_left", "left")))
    return TreeModel(both, roots, np.concatenate(values), models[0].mean, models[0].start)


def _tree_gains(forest: Forest, n_features: int) -> np.ndarray:
    """Gains by tree and feature."""
    total = np.zeros((len(forest.plans), n_features))
    own = forest.cut >= 0
    np.add.at(total, (forest.tree[own], forest.feature[own]), forest.gain[own])
    return total


def _add_gains(out: Fitted, i: int, forest: Forest, nodes: np.ndarray, n_features: int) -> None:
    own = nodes & (forest.cut >= 0)
    total = out.gains.setdefault(i, np.zeros(n_features))
    np.add.at(total, forest.feature[own], forest.gain[own])


def _boost_plan(i: int, fit: Fit, round_: int) -> TreePlan:
    p, n = fit.spec.params, len(fit.features)
    plan = TreePlan(i, seed_of(fit.seed, "round", round_), fit.conditions, fit.features, max_depth=int(p.get("max_depth", 3)),
                    subsample=float(p.get("subsample", 1.0)), min_leaf=int(p.get("min_leaf", 1)),
                    min_split=int(p.get("min_samples_split", 2)), min_gain=float(p.get("min_gain", 0.0)),
                    tree_features=float(p.get("colsample", 1.0)), node_features=node_features(p.get("max_features", "all"), n))
    if fit.spec.kind == "gbt":
        return replace(plan, criterion="variance")
    if fit.spec.kind == "leafwise" and not int(p.get("subsample_freq", 0)):
        plan = replace(plan, subsample=1.0)  # rows are drawn only where a frequency asks for it
    plan = replace(plan, criterion="newton", l1=float(p.get("l1", 0.0)))
    if fit.spec.kind == "xgb":
        return replace(plan, l2=float(p.get("l2", 1.0)), min_hessian=float(p.get("min_child_weight", 1.0)))
    depth = int(p.get("max_depth", -1))
    return replace(plan, leaves=int(p.get("num_leaves", 31)), max_depth=depth if depth > 0 else 60, l2=float(p.get("l2", 0.0)),
                   min_leaf=int(p.get("min_leaf", 20)), min_hessian=float(p.get("min_child_weight", 1e-3)))


def leaf_values(plans: Sequence[TreePlan], forest: Forest, rates: Sequence[float]) -> np.ndarray:
    """Newton step of each node, times its model's learning rate."""
    g, h = forest.stats[:, 1] / UNIT, forest.stats[:, 2] / UNIT
    l1 = np.array([p.l1 for p in plans])[forest.tree]
    l2 = np.array([p.l2 for p in plans])[forest.tree]
    g = np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)
    return np.array(rates)[forest.tree] * -g / np.maximum(h + l2, 1e-12)


@dataclass
class Layer:
    """Trees of one round, one per model in ``models``."""

    routes: Routes
    models: list[int]
    values: np.ndarray


@dataclass
class Margins:
    """Margins of all models on the cells of a block: what its state column holds (or the starts), plus the rounds since."""

    starts: np.ndarray
    recent: list[Layer]

    def __call__(self, batch: pa.RecordBatch, own: Cells):
        f = self.matrix(batch, own)

        def of_model(m: int) -> tuple[np.ndarray, np.ndarray]:
            p = sigmoid(f[m])
            return (np.rint((p - own.labels) * UNIT).astype(np.int64), np.rint(np.maximum(p * (1.0 - p), 1e-9) * UNIT).astype(np.int64))

        return of_model

    def matrix(self, batch: pa.RecordBatch, own: Cells) -> np.ndarray:
        at = batch.schema.get_field_index("margins")
        f = np.frombuffer(batch.column(at)[0].as_buffer()).reshape(len(self.starts), -1).copy() if at >= 0 else \
            np.repeat(self.starts[:, None], len(own), axis=1)
        for layer in self.recent:
            for t, m in enumerate(layer.models):
                f[m] += layer.values[layer.routes.leaf_of(t, own.bins)]
        return f


def _with_margins(packed: Packed, state: DataFrame, margins: Margins) -> DataFrame:
    """The cells (and what drawing rows needs) with their margins."""
    shared = state.sparkSession.sparkContext.broadcast(margins)
    splits, d = packed.splits, len(packed.features)
    names = [*CELL_COLUMNS, *ROW_COLUMNS]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            f = shared.value.matrix(batch, cells_of(batch, splits, d))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names), pa.array([f.tobytes()])],
                                             names=[*names, "margins"])

    source = state.select(*names, *(c for c in ("margins",) if c in state.columns))
    return source.mapInArrow(work, ", ".join(f"{c} binary" for c in (*names, "margins")))


def _starts(counts: np.ndarray, which: Sequence[int]) -> np.ndarray:
    """Log odds of label 1 among the rows of each model."""
    share = np.clip((counts[:, 1] + 1e-9) / np.maximum(counts[:, 0], 1), 1e-6, 1 - 1e-6)
    return np.array([math.log(share[c] / (1 - share[c])) for c in which])


def _boosted_in_tasks(packed: Packed, table: Table, fits: Sequence[tuple[int, Fit]], out: Fitted) -> None:
    """Each model grown through all its rounds in a task."""
    starts = _starts(table.label_counts([f.conditions for _, f in fits]), range(len(fits)))
    models = [Boosting([_boost_plan(k, f, r) for r in range(int(f.spec.params.get("n_rounds", 20)))], float(starts[k]),
                       float(f.spec.params.get("learning_rate", 0.1)), []) for k, (_, f) in enumerate(fits)]
    for k, trees in enumerate(grow_boosted(packed, table, models, leaf_values)):
        i = fits[k][0]
        for forest, _ in trees:
            _add_gains(out, i, forest, forest.tree == 0, len(packed.features))
        parts = [TreeModel(forest.routes(), [0], values, False) for forest, values in trees]
        out.models[i] = replace(joined(parts), start=float(starts[k]))


def fit_boosted(packed: Packed, fits: Sequence[tuple[int, Fit]], out: Fitted) -> None:
    """All boosted models, round by round."""
    table = table_of(packed)
    if table is not None:
        _boosted_in_tasks(packed, table, fits, out)
        return
    conditions = list(dict.fromkeys(f.conditions for _, f in fits))
    starts = _starts(_label_counts(packed, conditions), [conditions.index(f.conditions) for _, f in fits])
    state, held, layer = packed.frame, [], None
    parts: dict[int, list[TreeModel]] = {i: [] for i, _ in fits}
    rounds = [int(f.spec.params.get("n_rounds", 20)) for _, f in fits]
    for r in range(max(rounds)):
        if layer is not None:  # the margins are added up once a round
            state = _with_margins(packed, state, Margins(starts, [layer]))
            if r % ROUNDS_PER_STATE == 0:
                state = cut_lineage(state)
            state = state.persist()
            held.append(state)
        active = [k for k in range(len(fits)) if r < rounds[k]]
        plans = [_boost_plan(k, fits[k][1], r) for k in active]  # a plan's model is its row of the margins
        forest = grow(packed, state, plans, Margins(starts, []))
        values = leaf_values(plans, forest, [float(fits[k][1].spec.params.get("learning_rate", 0.1)) for k in active])
        layer = Layer(forest.routes(), active, values)
        for t, k in enumerate(active):
            own = np.flatnonzero(forest.tree == t)
            parts[fits[k][0]].append(_cut_out(forest, own, values))
            _add_gains(out, fits[k][0], forest, forest.tree == t, len(packed.features))
        for old in held[:-1]:
            old.unpersist()
        held = held[-1:]
    for old in held:
        old.unpersist()
    for k, (i, _) in enumerate(fits):
        out.models[i] = replace(joined(parts[i]), start=float(starts[k]))


def _cut_out(forest: Forest, own: np.ndarray, values: np.ndarray) -> TreeModel:
    """The nodes ``own`` of one tree as a model of their own."""
    place = np.full(len(forest.tree), -1, dtype=np.int32)
    place[own] = np.arange(len(own))
    left = np.where(forest.left[own] >= 0, place[forest.left[own]], -1).astype(np.int32)
    return TreeModel(Routes(forest.feature[own], forest.cut[own], forest.null_left[own], left), [0], values[own], False)


def block_sums(packed: Packed, n: int, per_block: Callable) -> dict[int, np.ndarray]:
    """Sums over all blocks of what ``per_block(block)`` yields as (key, array); one array a key reaches the driver.
    ``per_block.columns``, if there, are the columns that it reads."""
    shared = packed.frame.sparkSession.sparkContext.broadcast(per_block)
    splits, d = packed.splits, len(packed.features)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in with_batch(batches, splits, d):
            for key, values in shared.value(block):
                yield pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([values.astype(float).tobytes()])], names=["key", "values"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, key in enumerate(batch.column(0).to_pylist()):
                v = np.frombuffer(batch.column(1)[i].as_buffer())
                held[key] = held[key] + v if key in held else v
        for key, v in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([v.tobytes()])], names=["key", "values"])

    cores = packed.frame.sparkSession.sparkContext.defaultParallelism
    frame = packed.frame.select(*getattr(per_block, "columns", packed.frame.columns))
    merged = frame.mapInArrow(work, "key int, values binary").repartition(max(1, min(n, cores)), "key").mapInArrow(merge, "key int, values binary")
    out = {r["key"]: np.frombuffer(r["values"]) for r in merged.collect()}
    shared.unpersist()
    return out


@dataclass
class Moments:
    """Rows, sums and squares of each fit's features."""

    fits: list[Fit]
    columns = RAW_COLUMNS

    def __call__(self, block: Block):
        for k, f in enumerate(self.fits):
            x = block.raw[np.ix_(np.flatnonzero(block.trains(f.conditions)), f.features)]
            yield k, np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])


def scales(moments: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and population deviation (1 for a constant) of each feature."""
    n, total, squares = moments[0], moments[1:d + 1], moments[d + 1:]
    mean = total / n
    scale = np.sqrt(np.maximum(squares / n - mean ** 2, 0.0))
    return mean, np.where(scale > 1e-12 * np.maximum(1.0, np.abs(mean)), scale, 1.0)


@dataclass
class _Logistic:
    """Loss, gradient and Hessian of logistic fits. Fits that read the same columns (or map) share them, and the
    products of columns that their Hessians weigh."""

    groups: list[tuple[tuple[int, ...] | FourierMap, list[tuple[int, tuple[Condition, ...], np.ndarray]]]]
    columns = RAW_COLUMNS

    def __call__(self, block: Block):
        for design, own in self.groups:
            conditions = list(dict.fromkeys(c for _, c, _ in own))
            used = np.stack([block.trains(c) for c in conditions], axis=1)
            which = [conditions.index(c) for _, c, _ in own]
            rows = np.flatnonzero(used.any(axis=1))
            w = np.stack([w for _, _, w in own], axis=1)
            m, n = w.shape
            a, b = np.triu_indices(m)
            loss, g, h = np.zeros(n), np.zeros((m, n)), np.zeros((m, m, n))
            for at in range(0, len(rows), CHUNK_ROWS):
                r = rows[at:at + CHUNK_ROWS]
                raw = block.raw[r]
                x = np.column_stack([raw[:, design] if isinstance(design, tuple) else design(raw), np.ones(len(r))])
                y, on = block.labels[r].astype(float)[:, None], used[r][:, which]
                z = x @ w
                e = np.exp(-np.abs(z))
                p = np.where(z >= 0, 1.0, e) / (1.0 + e)
                loss += ((np.maximum(z, 0.0) + np.log1p(e) - y * z) * on).sum(axis=0)
                g += x.T @ ((p - y) * on)
                v = p * (1.0 - p) * on
                if n < 4:
                    for j in range(n):
                        h[:, :, j] += x.T @ (x * v[:, j:j + 1])
                else:
                    h[a, b] += (x[:, a] * x[:, b]).T @ v
            if n >= 4:
                h[b, a] = h[a, b]
            for j, (k, _, _) in enumerate(own):
                yield k, np.concatenate([[loss[j]], g[:, j], h[:, :, j].ravel()])


def fit_linear(packed: Packed, fits: Sequence[tuple[int, Fit]], out: Fitted, tolerance: float = 1e-9,
               maps: Sequence[FourierMap] | None = None) -> None:
    """Logistic regressions by Newton steps, all of them in each pass; an L1 share is handled by coordinate descent on the
    quadratic model of the step. Penalty: (l1_ratio * |w| + (1 - l1_ratio) / 2 * w^2) / C, the intercept free.
    ``maps``, one a fit, stand between the features and the model. The first steps on a large frame are made on a part of its rows, with
    the penalty in the same proportion; the last ones, until nothing is gained, on all rows."""
    designs = maps or [f.features for _, f in fits]
    weights = [np.zeros((len(d) if isinstance(d, tuple) else len(d.phases)) + 1) for d in designs]
    if packed.n_rows >= LARGE * START_ROWS:
        weights = _newton(packed.part(START_ROWS), fits, designs, weights, tolerance, START_ROWS / packed.n_rows)
    weights = _newton(packed, fits, designs, weights, tolerance)
    for k, (i, f) in enumerate(fits):
        out.models[i] = LinearModel(f.features, weights[k], maps[k] if maps else None)


def _newton(packed: Packed, fits: Sequence[tuple[int, Fit]], designs: Sequence, weights: list[np.ndarray], tolerance: float,
            share: float | None = None) -> list[np.ndarray]:
    """Weights of all fits from the given ones on; ``share``: the rows are this part of all, and a fit that finds none stays where it is."""
    n, start, weights = len(fits), weights, list(weights)
    previous, objective = [w.copy() for w in weights], [math.inf] * n
    limit = max(int(f.spec.params.get("max_iter", 100)) for _, f in fits)
    open_ = set(range(n))
    for _ in range(limit):
        if not open_:
            break
        groups: dict = {}
        for k in sorted(open_):
            groups.setdefault(designs[k] if isinstance(designs[k], tuple) else k, []).append((k, fits[k][1].conditions, weights[k]))
        got = block_sums(packed, len(open_), _Logistic([(designs[own[0][0]], own) for own in groups.values()]))  # (features + 1)^2 numbers a model
        for k in sorted(open_):
            if k not in got or not np.isfinite(got[k]).all():
                if share:
                    open_.discard(k)
                    previous[k] = start[k]
                    continue
                raise ValueError("linear models need rows, and features without nulls")
            m = len(weights[k])
            loss, g, h = got[k][0], got[k][1:1 + m], got[k][1 + m:].reshape(m, m)
            p = fits[k][1].spec.params
            strength, ratio = (share or 1.0) / float(p.get("C", 1.0)), float(p.get("l1_ratio", 0.0))
            l1, l2 = strength * ratio * np.append(np.ones(m - 1), 0.0), strength * (1 - ratio) * np.append(np.ones(m - 1), 0.0)
            now = loss + (l1 * np.abs(weights[k])).sum() + 0.5 * (l2 * weights[k] ** 2).sum()
            if now > objective[k] + 1e-9 * (1 + abs(objective[k])):  # too far: half the way
                weights[k] = 0.5 * (weights[k] + previous[k])
                if np.abs(weights[k] - previous[k]).max() < 1e-12:
                    open_.discard(k)
                continue
            gained = objective[k] - now
            objective[k], previous[k] = now, weights[k]
            if gained < tolerance * (1 + abs(now)):
                open_.discard(k)
                continue
            weights[k] = weights[k] + _newton_step(weights[k], g, h, l1, l2)
    return previous


def fit_fourier(packed: Packed, fits: Sequence[tuple[int, Fit]], out: Fitted) -> None:
    """Logistic fits on random Fourier features of the standardised input, each standardised on its own rows."""
    moments = block_sums(packed, len(fits), Moments([f for _, f in fits]))
    maps = []
    for k, (_, f) in enumerate(fits):
        d = len(f.features)
        if k not in moments or not np.isfinite(moments[k]).all():
            raise ValueError("linear models need rows, and features without nulls")
        p = f.spec.params
        w, b = rff_weights(d, int(p.get("n_components", 50)), float(p.get("gamma", 1.0 / max(d, 1))), f.seed)
        maps.append(FourierMap(f.features, *scales(moments[k], d), w, b))
    fit_linear(packed, fits, out, maps=maps)


def _newton_step(w: np.ndarray, g: np.ndarray, h: np.ndarray, l1: np.ndarray, l2: np.ndarray, sweeps: int = 1_000) -> np.ndarray:
    h = h + np.diag(l2 + 1e-12 * max(1.0, float(np.trace(h))) / len(w))
    g = g + l2 * w
    if not l1.any():
        return -np.linalg.lstsq(h, g, rcond=None)[0]
    step = np.zeros(len(w))
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(w)):
            if h[j, j] <= 0:
                continue
            rest = g[j] + h[j] @ step - h[j, j] * step[j] - h[j, j] * w[j]
            new = -np.sign(rest) * max(abs(rest) - l1[j], 0.0) / h[j, j] - w[j]
            moved = max(moved, abs(new - step[j]) * math.sqrt(h[j, j]))
            step[j] = new
        if moved < 1e-10:
            break
    return step


KINDS = {"forest": fit_forests, "gbt": fit_boosted, "xgb": fit_boosted, "leafwise": fit_boosted, "logreg": fit_linear, "rff": fit_fourier}
#: Kinds that read bins; the others read the features as they are.
TREES = {"forest", "gbt", "xgb", "leafwise"}


def fit_all(packed: Packed, fits: Sequence[Fit]) -> Fitted:
    """Fits all models, each kind in one go."""
    from tabforge.training.svm import fit_svms

    kinds = KINDS | {"svm": fit_svms}
    out = Fitted(list(fits), [None] * len(fits))
    for trainer in dict.fromkeys(kinds[f.spec.kind] for f in fits):
        trainer(packed, [(i, f) for i, f in enumerate(fits) if kinds[f.spec.kind] is trainer], out)
    return out


def pack_for(df: DataFrame, specs: Sequence[ModelSpec], features: Sequence[str], splits: Sequence[str], label: str = "label", id_col: str = "id",
             max_bins: int = 64, strict: bool = False) -> Packed:
    """``pack``; no edges are looked for where no model reads bins, and where the frame is packed already that is used."""
    if (held := shared_pack(df, features, splits, label, id_col, max_bins, strict)) is not None:
        return held
    edges = None if any(s.kind in TREES for s in specs) else [np.zeros(0)] * len(features)
    return pack(df, features, splits, label, id_col, max_bins, edges, strict)


# -- tables ---------------------------------------------------------------------------------------------------
def cross_fits(packed: Packed, specs: Sequence[ModelSpec], features: Sequence[str], folds: Sequence[int], fold_col: str = "fold",
               seed: int = 42, with_full: bool = True) -> list[Fit]:
    """Each configuration with each fold held out, and on all rows."""
    at = tuple(packed.features.index(f) for f in features)
    held = [((fold_col, int(f)),) for f in folds] + ([()] if with_full else [])
    return [Fit(s, at, c, seed) for s in specs for c in held]


def _labelled(preds: DataFrame, fits: Sequence[Fit], extra: Sequence[dict] | None = None) -> DataFrame:
    """Adds model, seed, fold (-1: fitted on all rows) and columns of ``extra`` (one dict per fit)."""
    spark = preds.sparkSession
    extra = extra or [{} for _ in fits]
    names = list(extra[0]) if extra else []
    rows = [(i, f.spec.name, f.seed, f.conditions[-1][1] if f.conditions else -1, *(str(e[c]) for c in names)) for i, (f, e) in enumerate(zip(fits, extra, strict=True))]
    table = spark.createDataFrame(rows, "fit int, model string, seed int, fold int" + "".join(f", `{c}` string" for c in names))
    return preds.join(F.broadcast(table), "fit").drop("fit")  # one row per fit


def named(preds: DataFrame, fits: Sequence[Fit], extra: Sequence[dict] | None = None) -> DataFrame:
    """Adds model, seed, fold (-1: fitted on all rows), pred, and columns of ``extra`` (one dict per fit)."""
    return _labelled(preds, fits, extra).withColumn("pred", (F.col("proba") >= 0.5).cast("int"))


def folds_of(df: DataFrame, fold_col: str = "fold") -> list[int]:
    """The fold numbers; a column of few values."""
    return sorted(r[0] for r in df.select(fold_col).distinct().collect())


def cv_table(df: DataFrame, specs: Sequence[ModelSpec], feature_sets: dict[str, Sequence[str]], label: str = "label", id_col: str = "id",
             fold_col: str = "fold", seed: int = 42, with_train: bool = True, max_bins: int = 64) -> DataFrame:
    """The cross-validation table of all configurations on all feature sets, fitted together."""
    every = list(dict.fromkeys(f for fs in feature_sets.values() for f in fs))
    packed = pack_for(df, specs, every, [fold_col], label, id_col, max_bins)
    folds = folds_of(df, fold_col)
    fits, extra = [], []  # one entry per configuration, feature set and fold
    for name, feats in feature_sets.items():
        own = cross_fits(packed, specs, feats, folds, fold_col, seed, with_train)
        fits += own
        extra += [{"feature_set": name, "n_features": len(feats)}] * len(own)
    scores = fit_scores(packed, fit_all(packed, fits), extra)
    packed.release()
    return scores_summary(scores, ["model", "feature_set", "n_features"], with_train).withColumn("n_features", F.col("n_features").cast("int"))


def oof_table(df: DataFrame, specs: Sequence[ModelSpec], features: Sequence[str], label: str = "label", id_col: str = "id",
              fold_col: str = "fold", seed: int = 42, max_bins: int = 64, strict: bool = False) -> DataFrame:
    """M7: out-of-fold predictions of all configurations: id, model, seed, fold, label, proba, pred."""
    packed = pack_for(df, specs, features, [fold_col], label, id_col, max_bins, strict)
    fits = cross_fits(packed, specs, features, folds_of(df, fold_col), fold_col, seed, with_full=False)
    out = cut_lineage(named(predictions(packed, fit_all(packed, fits)), fits))
    packed.release()
    return out.select(id_col, "model", "seed", "fold", "label", "proba", "pred")


def strategy_table(df: DataFrame, specs: Sequence[ModelSpec], features: Sequence[str], strategies: dict[str, str], label: str = "label",
                   id_col: str = "id", seed: int = 42, max_bins: int = 64, vote: str | None = "vote") -> DataFrame:
    """All configurations under several fold columns (strategy -> column), fitted together, and the majority vote of
    their labels: model, strategy, cv_score, cv_std, oof_score, train_score, gap, gap_pct."""
    packed = pack(df, features, list(strategies.values()), label, id_col, max_bins)
    at = tuple(range(len(features)))
    fits, extra = [], []
    for name, column in strategies.items():
        own = cross_fits(packed, specs, features, folds_of(df, column), column, seed, with_full=False)
        fits += own
        extra += [{"strategy": name}] * len(own)
    fits += [Fit(s, at, (), seed) for s in specs]
    extra += [{"strategy": ""}] * len(specs)
    fitted = fit_all(packed, fits)
    scores = fit_scores(packed, fitted, extra)
    if vote:
        votes = cut_lineage(_labelled(ballots(packed, fitted), fits, extra).withColumn("model", F.lit(vote)))
        scores = scores.unionByName(votes.select(scores.columns))
    packed.release()
    out = scores_summary(scores, ["model", "strategy"])
    train = scores.where("fold = -1").groupBy("model").agg((F.sum("hits") / F.sum("n")).alias("train_score"))
    out = out.join(train, "model")
    gap = F.col("train_score") - F.col("cv_score")
    return out.withColumn("gap", gap).withColumn("gap_pct", F.try_divide(100 * gap, F.col("train_score")))


def stacked_table(df: DataFrame, bases: Sequence[ModelSpec], metas: Sequence[tuple[ModelSpec, Sequence[str]]], features: Sequence[str],
                  label: str = "label", id_col: str = "id", fold_col: str = "fold", inner_folds: int = 5, seed: int = 42,
                  max_bins: int = 64) -> DataFrame:
    """Out-of-fold predictions of stacked models, nested: id, model, seed, fold, label, proba, pred.

    Every row has an inner fold, stratified within its outer fold and label. For each outer fold the bases are fitted on the rest, and on
    the rest without each inner fold; the latter's held-out probabilities train the metas, the former's are what
    the metas see in the outer fold. All base fits of a kind run together, and so do all metas."""
    folds = folds_of(df, fold_col)
    strata = df.withColumn("_strata", F.col(fold_col) * 2 + F.col(label))
    df = cut_lineage(stratified_folds(strata, id_col, "_strata", inner_folds, seed, "_inner").drop("_strata"))
    packed = pack(df, features, [fold_col, "_inner"], label, id_col, max_bins)
    at = tuple(range(len(features)))
    fits, extra = [], []
    for f in folds:
        outer = ((fold_col, f),)
        for b in bases:
            for c in (outer, *[(*outer, ("_inner", i)) for i in range(inner_folds)]):
                fits.append(Fit(b, at, c, seed))
                extra.append({"_outer": f})
    preds = named(predictions(packed, fit_all(packed, fits)), fits, extra)
    names = [f"_proba_{b.name}" for b in bases]  # no clash with passed features
    wide = (preds.withColumn("model", F.concat(F.lit("_proba_"), "model")).groupBy(id_col, F.col("_outer").cast("int").alias("_outer"))
            .pivot("model", names).agg(F.first("proba")))
    keep = sorted({c for _, used in metas for c in used})
    wide = cut_lineage(wide.join(df.select(id_col, label, fold_col, *keep), id_col))
    packed.release()
    # per outer fold a column: 0 not its rows, 1 the rest, 2 the fold itself
    sides = {f: f"_side{f}" for f in folds}
    wide = wide.withColumns({c: F.when(F.col("_outer") != f, F.lit(0)).when(F.col(fold_col) == f, F.lit(2)).otherwise(F.lit(1)) for f, c in sides.items()})
    stacked = pack_for(wide, [m for m, _ in metas], [*names, *keep], list(sides.values()), label, id_col, 2)
    fits = [Fit(spec, tuple(stacked.features.index(c) for c in [*names, *used]), ((c, 0), (c, 2)), seed) for spec, used in metas for c in sides.values()]
    which = [{"_fold": f} for _ in metas for f in folds]
    out = cut_lineage(named(predictions(stacked, fit_all(stacked, fits)), fits, which))
    stacked.release()
    return out.select(id_col, "model", "seed", F.col("_fold").cast("int").alias("fold"), "label", "proba", "pred")


def calibrated_table(df: DataFrame, specs: Sequence[ModelSpec], features: Sequence[str], inner_folds: Sequence[int] = (2, 5), label: str = "label",
                     id_col: str = "id", fold_col: str = "fold", seed: int = 42, max_bins: int = 64) -> DataFrame:
    """Out-of-fold predictions of all configurations, as they are (cv 0) and isotonically calibrated over 2 and 5
    inner folds: id, model, cv, fold, label, proba, pred. Inner folds are stratified within outer fold and label; for each
    the model is fitted without it, calibrated on it, and the calibrated probabilities of the inner models are averaged."""
    from tabforge.operators.isotonic import isotonic_values

    folds = folds_of(df, fold_col)
    marked = df.withColumn("_strata", F.col(fold_col) * 2 + F.col(label))
    for k in inner_folds:
        marked = stratified_folds(marked, id_col, "_strata", k, seed, f"_inner{k}")
    marked = cut_lineage(marked.drop("_strata"))
    packed = pack(marked, features, [fold_col, *[f"_inner{k}" for k in inner_folds]], label, id_col, max_bins)
    at = tuple(range(len(features)))
    fits, extra = [], []
    for s in specs:
        for f in folds:
            for k, i in [(0, 0), *[(k, i) for k in inner_folds for i in range(k)]]:
                fits.append(Fit(s, at, ((fold_col, f),) + (((f"_inner{k}", i),) if k else ()), seed))
                extra.append({"outer": f, "cv": k, "inner": i})
    fitted = fit_all(packed, fits)
    # an inner model scores its inner fold (to calibrate) and the outer fold (to predict): the first condition alone, then both
    outside = Fitted([Fit(f.spec, at, f.conditions[:1], seed) for f in fits], fitted.models)
    held = named(predictions(packed, fitted), fits, extra).where("cv <> '0'")
    preds = cut_lineage(named(predictions(packed, outside), outside.fits, extra))
    packed.release()
    plain = preds.where("cv = '0'").select(id_col, "model", F.lit(0).alias("cv"), "fold", "label", "proba")
    name = F.concat_ws("|", "model", "cv", "outer", "inner").alias("key")
    scored = preds.where("cv <> '0'").select(name, id_col, "model", F.col("cv").cast("int").alias("cv"), "fold", "label", F.col("proba").alias("score"))
    both = held.select(name, F.col("proba").alias("score"), F.col("label").alias("y")).unionByName(scored.select("key", "score", F.lit(None).cast("int").alias("y")))
    values = isotonic_values(both, "key", "score", "y").select("key", "score", "value")
    fixed = scored.join(values, ["key", "score"]).groupBy(id_col, "model", "cv", "fold", "label").agg(F.avg("value").alias("proba"))
    return plain.unionByName(fixed).withColumn("pred", (F.col("proba") >= 0.5).cast("int"))
