"""RBF support vector machines with probabilities (L7), all fits side by side.

The kernel is approximated with Nystroem features: landmarks drawn from a
bounded sample (``SAMPLE`` rows, by key) and spread by distance, mapped by the inverse root of their own
kernel matrix. ``kernel_error`` states how far the approximate kernel is from the
exact one. Squared hinge loss is minimised by Newton steps; each pass over the
blocks adds up the gradients and Hessians of every fit. Probabilities are Platt's: a logistic curve over
margins of rows that the margin's model did not see (``INNER`` folds by key).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa

from tabforge.training.blocks import Block, Packed, uniform
from tabforge.training.fits import CHUNK_ROWS, Fit, Fitted, Moments, block_sums, scales, sigmoid
from tabforge.training.trees import with_batch

SAMPLE, INNER = 4_096, 5


@dataclass
class KernelMap:
    """Standardised features to Nystroem features."""

    features: tuple[int, ...]
    mean: np.ndarray
    scale: np.ndarray
    landmarks: np.ndarray
    root: np.ndarray
    gamma: float

    def kernel(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.exp(-self.gamma * np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0.0))

    def standard(self, raw: np.ndarray) -> np.ndarray:
        return (raw[:, self.features] - self.mean) / self.scale

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        """Features, and a 1 for the intercept."""
        return np.column_stack([self.kernel(self.standard(raw), self.landmarks) @ self.root, np.ones(len(raw))])


@dataclass
class SvmModel:
    map: KernelMap
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, raw: np.ndarray) -> np.ndarray:
        return self.map(raw) @ self.weights

    def proba(self, block: Block, rows: np.ndarray) -> np.ndarray:
        return self.proba_of(block.raw[rows])

    def proba_of(self, raw: np.ndarray, edges: Sequence[np.ndarray] | None = None) -> np.ndarray:
        return sigmoid(self.slope * self.margin(raw) + self.shift)


def kernel_error(kernel_map: KernelMap, raw: np.ndarray) -> float:
    """Relative Frobenius distance of the approximate kernel matrix of ``raw`` from the exact one."""
    z = kernel_map(raw)[:, :-1]
    exact = kernel_map.kernel(kernel_map.standard(raw), kernel_map.standard(raw))
    return float(np.linalg.norm(exact - z @ z.T) / np.linalg.norm(exact))


def spread(rows: np.ndarray, n: int, seed: int) -> np.ndarray:
    """``n`` rows, each drawn with a weight of its squared distance to the nearest one so far."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(rows)))]
    near = ((rows - rows[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < n and near.max() > 1e-12:
        chosen.append(int(np.searchsorted(np.cumsum(near), rng.random() * near.sum())))
        near = np.minimum(near, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
    return rows[chosen]


@dataclass
class _Task:
    """A margin model: a fit without the rows of inner fold ``inner`` (-1: of all its rows)."""

    fit: Fit
    map: KernelMap
    weights: np.ndarray
    inner: int

    def part(self, keys: np.ndarray) -> np.ndarray:
        """Inner fold of each key."""
        return np.floor(uniform(keys, self.fit.seed + 1) * INNER).astype(np.int64)

    def held_out(self, block: Block) -> np.ndarray:
        return np.flatnonzero(block.trains(self.fit.conditions) & (self.part(block.keys) == self.inner))


@dataclass
class _Hinge:
    """Loss, gradient and Hessian of the squared hinge. The margin models of a fit see nearly the same rows: rows that
    are within the margin of all of them enter one matrix per inner fold, which their Hessians add up; only the other rows
    are taken model by model."""

    tasks: list[tuple[int, _Task]]

    def __call__(self, block: Block):
        groups: dict[int, list[tuple[int, _Task]]] = {}
        for k, t in self.tasks:
            groups.setdefault(id(t.map), []).append((k, t))
        for own in groups.values():
            first = own[0][1]
            inner = np.array([t.inner for _, t in own])
            w = np.stack([t.weights for _, t in own], axis=1)
            m, n = w.shape
            loss, g, h = np.zeros(n), np.zeros((m, n)), np.zeros((n, m, m))
            common = np.zeros((INNER, m, m))
            rows = np.flatnonzero(block.trains(first.fit.conditions))
            for at in range(0, len(rows), CHUNK_ROWS):
                r = rows[at:at + CHUNK_ROWS]
                z, part, y = first.map(block.raw[r]), first.part(block.keys[r]), 2.0 * block.labels[r].astype(float) - 1.0
                slack = 1.0 - y[:, None] * (z @ w)
                live = slack > 0
                mine = part[:, None] != inner
                weighed = np.where(live & mine, slack, 0.0)
                loss += (weighed ** 2).sum(axis=0)
                g -= 2.0 * z.T @ (y[:, None] * weighed)
                shared = live.all(axis=1)
                for i in range(INNER):
                    a = z[shared & (part == i)]
                    common[i] += a.T @ a
                for j in range(n):
                    a = z[live[:, j] & mine[:, j] & ~shared]
                    h[j] += a.T @ a
            for j, (k, _) in enumerate(own):
                yield k, np.concatenate([[loss[j]], g[:, j], 2.0 * (h[j] + common[np.arange(INNER) != inner[j]].sum(axis=0)).ravel()])


@dataclass
class _Platt:
    """Loss, gradient and Hessian of the logistic curve over held-out margins, with Platt's smoothed targets."""

    tasks: list[tuple[int, _Task]]
    curve: dict[int, np.ndarray]
    targets: dict[int, tuple[float, float]]

    def __call__(self, block: Block):
        maps: dict[int, np.ndarray] = {}
        for k, t in self.tasks:
            z = maps.setdefault(id(t.map), None)
            if z is None:
                z = maps[id(t.map)] = t.map(block.raw)
            rows = t.held_out(block)
            x = np.column_stack([z[rows] @ t.weights, np.ones(len(rows))])
            y = np.where(block.labels[rows] == 1, self.targets[k][1], self.targets[k][0])
            s = x @ self.curve[k]
            p = sigmoid(s)
            yield k, np.concatenate([[np.logaddexp(0.0, s).sum() - y @ s], x.T @ (p - y), ((x * (p * (1 - p))[:, None]).T @ x).ravel(),
                                     [len(rows), block.labels[rows].sum()]])


def _sample(packed: Packed, seed: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Raw features and split columns of about ``SAMPLE`` rows, drawn by key."""
    rate = min(1.0, SAMPLE / max(1, packed.n_rows))
    splits, d = packed.splits, len(packed.features)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in with_batch(batches, splits, d):
            rows = np.flatnonzero(uniform(block.keys, seed) < rate)
            table = np.column_stack([block.raw[rows], *[block.splits[s][rows] for s in splits]])
            order = block.keys[rows].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(order), pa.array(list(table), pa.list_(pa.float64()))], names=["key", "row"])

    got = sorted(packed.frame.mapInArrow(work, "key long, row array<double>").collect())
    table = np.array([r["row"] for r in got]).reshape(len(got), -1)
    return table[:, :d], {s: table[:, d + j].astype(int) for j, s in enumerate(splits)}


def fit_svms(packed: Packed, fits: Sequence[tuple[int, Fit]], out: Fitted, max_steps: int = 30) -> None:
    """Params: C (1), gamma (1 / number of features, on standardised input), n_landmarks (64)."""
    raw, splits = _sample(packed, 17)
    moments = block_sums(packed, len(fits), Moments([f for _, f in fits]))
    tasks: list[_Task] = []
    for k, (_, f) in enumerate(fits):
        d = len(f.features)
        if k not in moments or not np.isfinite(moments[k]).all():
            raise ValueError("support vector machines need rows, and features without nulls")
        base = KernelMap(f.features, *scales(moments[k], d), np.zeros((0, d)), np.zeros((0, 0)), float(f.spec.params.get("gamma", 1.0 / d)))
        own = np.ones(len(raw), dtype=bool)
        for column, value in f.conditions:
            own &= splits[column] != value
        marks = spread(base.standard(raw[own]), int(f.spec.params.get("n_landmarks", 64)), f.seed)
        values, vectors = np.linalg.eigh(base.kernel(marks, marks))
        keep = values > 1e-10 * values.max()
        kernel_map = replace(base, landmarks=marks, root=vectors[:, keep] / np.sqrt(values[keep]))
        size = int(keep.sum()) + 1
        tasks += [_Task(f, kernel_map, np.zeros(size), inner) for inner in range(-1, INNER)]

    def solve(state: dict[int, np.ndarray], passes: Callable, penalty: Callable, set_state: Callable) -> None:
        best = dict.fromkeys(state, math.inf)
        held = {k: v.copy() for k, v in state.items()}
        open_ = set(state)
        for _ in range(max_steps):
            if not open_:
                return
            sums = block_sums(packed, len(open_), passes(sorted(open_)))
            for k in sorted(open_):
                m = len(state[k])
                c, pen = penalty(k)
                v = sums.get(k, np.zeros(1 + m + m * m))
                now = c * v[0] + 0.5 * (pen * state[k] ** 2).sum()
                if now > best[k] + 1e-10 * (1 + abs(best[k])):
                    state[k] = 0.5 * (state[k] + held[k])
                else:
                    gained, best[k], held[k] = best[k] - now, now, state[k]
                    if gained < 1e-7 * (1 + abs(now)):
                        open_.discard(k)
                    else:
                        h = c * v[1 + m:1 + m + m * m].reshape(m, m) + np.diag(pen + 1e-9)
                        state[k] = state[k] - np.linalg.solve(h, c * v[1:1 + m] + pen * state[k])
                set_state(k, state[k])
        for k in open_:
            set_state(k, held[k])

    weights = {k: t.weights for k, t in enumerate(tasks)}

    def put(k: int, w: np.ndarray) -> None:
        tasks[k].weights = w

    solve(weights, lambda ks: _Hinge([(k, tasks[k]) for k in ks]),
          lambda k: (float(tasks[k].fit.spec.params.get("C", 1.0)), np.append(np.ones(len(weights[k]) - 1), 0.0)), put)
    # one curve a fit: the inner models' held-out margins come under the key of their fit
    inner = [(k // (INNER + 1), t) for k, t in enumerate(tasks) if t.inner >= 0]
    curve = {k: np.array([1.0, 0.0]) for k in range(len(fits))}
    blank = {k: (0.0, 1.0) for k in curve}
    counts = block_sums(packed, len(fits), _Platt(inner, curve, blank))
    targets = {k: (1.0 / (v[-2] - v[-1] + 2.0), (v[-1] + 1.0) / (v[-1] + 2.0)) for k, v in counts.items()}
    solve(curve, lambda ks: _Platt([(k, t) for k, t in inner if k in ks], {k: curve[k] for k in ks}, targets), lambda k: (1.0, np.zeros(2)),
          lambda k, w: curve.__setitem__(k, w))
    for k, (i, _) in enumerate(fits):
        own = tasks[k * (INNER + 1)]
        out.models[i] = SvmModel(own.map, own.weights, float(curve[k][0]), float(curve[k][1]))
