"""Points cut into boxes by medians (a k-d tree), and the nearest points of probes, for use within tasks.

Squared distances and bounds are summed in the order of the columns and scaled
alike; rounding keeps their order, so a box beyond a bound holds no point within it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Points that a probe is compared with at once.
SMALL = 64
#: Probes that are compared with a box at once.
PROBES_AT_ONCE = 8_192


@dataclass
class Boxes:
    """Nodes cut column ``dim`` (-1: a box) at ``cut``: what is not above goes left. ``low`` and ``high`` bound each box."""

    dim: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def __len__(self) -> int:
        return len(self.low)

    def home(self, x: np.ndarray) -> np.ndarray:
        """The box of each row."""
        at = np.zeros(len(x), dtype=np.int64)
        open_ = np.flatnonzero(self.dim[at] >= 0)
        while len(open_):
            node = at[open_]
            at[open_] = np.where(x[open_, self.dim[node]] <= self.cut[node], self.left[node], self.right[node])
            open_ = open_[self.dim[at[open_]] >= 0]
        return self.left[at]

    def within(self, x: np.ndarray, reach: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, box) of all boxes whose scaled squared distance from the row is at most its ``reach``."""
        rows, found, todo = [], [], [(0, np.arange(len(x)))]
        while todo:
            node, own = todo.pop()
            if not len(own):
                continue
            j, cut = self.dim[node], self.cut[node]
            if j < 0:
                box = self.left[node]
                total = np.zeros(len(own))
                for i in range(x.shape[1]):
                    v = x[own, i]
                    total += np.maximum(np.maximum(self.low[box, i] - v, v - self.high[box, i]), 0.0) ** 2
                own = own[~(total * scale > reach[own])]
                rows.append(own)
                found.append(np.full(len(own), box))
                continue
            v = x[own, j]
            near, close = v <= cut, ~((v - cut) ** 2 * scale > reach[own])
            todo += [(self.left[node], own[near | close]), (self.right[node], own[~near | close])]
        return np.concatenate(rows), np.concatenate(found)


def cut_boxes(x: np.ndarray, size: int) -> tuple[Boxes, list[np.ndarray]]:
    """Boxes of at most ``size`` rows (more only where all are equal), and the rows of each in their order."""
    dim, cut, left, right, members, ends = [-1], [0.0], [0], [0], [], []
    d = x.shape[1]
    todo = [(0, np.arange(len(x)), np.full(d, -np.inf), np.full(d, np.inf))]
    while todo:
        node, own, low, high = todo.pop()
        part = x[own]
        if len(own) > size:
            with np.errstate(invalid="ignore"):
                spread = np.nan_to_num(part.max(axis=0) - part.min(axis=0), nan=0.0)
            j = int(spread.argmax())
            if spread[j] > 0:
                v = part[:, j]
                at = np.partition(v, (len(v) - 1) // 2)[(len(v) - 1) // 2]
                at = at if at < v.max() else v[v < at].max()
                dim[node], cut[node], left[node], right[node] = j, at, len(dim), len(dim) + 1
                under, over = high.copy(), low.copy()
                under[j] = over[j] = at
                todo += [(len(dim), own[v <= at], low, under), (len(dim) + 1, own[v > at], over, high)]
                dim, cut, left, right = dim + [-1, -1], cut + [0.0, 0.0], left + [0, 0], right + [0, 0]
                continue
        left[node] = len(members)
        members.append(own)
        ends.append((low, high))
    return Boxes(np.array(dim), np.array(cut), np.array(left), np.array(right), np.stack([e[0] for e in ends]), np.stack([e[1] for e in ends])), members


def codes_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of each distinct one, and the number of each row's."""
    whole = np.ascontiguousarray(x)
    _, first, code = np.unique(whole.view(np.dtype((np.void, whole.shape[1] * whole.itemsize))).ravel(), return_index=True, return_inverse=True)
    return first, code


def first_of_equal(x: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` rows of smallest id of each distinct row, in the order of their ids."""
    _, code = codes_of(x)
    order = np.lexsort((ids, code))
    ranked = code[order]
    place = np.arange(len(order)) - np.searchsorted(ranked, ranked, side="left")
    kept = order[place < k]
    return kept[np.argsort(ids[kept], kind="stable")]


class Near:
    """The ``k`` nearest of ``points``, which are in the order in which equal distances are broken."""

    def __init__(self, points: np.ndarray, scale: float, k: int):
        self.points, self.scale, self.k = points, scale, k
        self.boxes, self.members = cut_boxes(points, SMALL)
        self.sides = [np.ascontiguousarray(points[m].T) for m in self.members]

    def _compared(self, x: np.ndarray, rows: np.ndarray, boxes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        order = np.argsort(boxes, kind="stable")
        rows, boxes = rows[order], boxes[order]
        starts = np.flatnonzero(np.diff(boxes, prepend=-1))
        for s, e in zip(starts, [*starts[1:], len(rows)]):  # no starts without rows
            own, side = self.members[boxes[s]], self.sides[boxes[s]]
            for at in range(s, e, PROBES_AT_ONCE):
                r = rows[at:min(at + PROBES_AT_ONCE, e)]
                d2 = np.zeros((len(r), len(own)))
                for j in range(x.shape[1]):
                    d2 += (x[r, j:j + 1] - side[j]) ** 2
                d2 *= self.scale
                best = np.argsort(d2, axis=1, kind="stable")[:, :self.k]
                yield r, own[best], np.take_along_axis(d2, best, axis=1)

    def __call__(self, x: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, point, scaled squared distance) of each row's nearest points not beyond its ``reach``, in order."""
        n, reach = len(x), reach.copy()
        home = self.boxes.home(x)
        found = []
        for r, p, d2 in self._compared(x, np.arange(n), home):
            if d2.shape[1] >= self.k:
                reach[r] = np.fmin(reach[r], d2[:, self.k - 1])
            found.append((r, p, d2))
        rows, boxes = self.boxes.within(x, reach, self.scale)
        other = boxes != home[rows]
        found += self._compared(x, rows[other], boxes[other])
        r = np.concatenate([np.repeat(r, p.shape[1]) for r, p, _ in found])
        p = np.concatenate([p.ravel() for _, p, _ in found])
        d2 = np.concatenate([d.ravel() for _, _, d in found])
        kept = ~(d2 > reach[r])
        r, p, d2 = r[kept], p[kept], d2[kept]
        order = np.lexsort((p, d2, r))
        r, p, d2 = r[order], p[order], d2[order]
        kept = np.arange(len(r)) - np.searchsorted(r, r, side="left") < self.k
        return r[kept], p[kept], d2[kept]
