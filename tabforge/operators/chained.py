"""Chained imputation from sufficient statistics.

One aggregation gives, for each pattern of missing columns, the count, sums and
cross products of the standardised columns. Everything after that is algebra on
small matrices: an imputed cell is a linear function of the row's observed
columns, so every round's regressions and the moments that its imputed cells change follow
from the first moments. The rows are read once to fit and once to fill.

Each round goes through the columns, fewest nulls first, and regresses each on
all others over the rows where it is observed; the null cells take the
prediction at once. Rounds end when no (pattern, column) moves by more than
``tolerance`` standard deviations in root mean square, or after ``max_rounds``.

Defined results: NaN counts as null; a column without a value stays null and takes no part; constant
columns are filled with their constant. Directions without variance are left out of a
regression (pseudo-inverse).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _known(c: str) -> Column:
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


@dataclass
class ChainedMoments:
    """A fitted imputer: ``steps`` are (column, coefficients over [1, others]) in the order of fitting."""

    cols: list[str]
    mean: np.ndarray
    scale: np.ndarray
    steps: list[tuple[int, np.ndarray]] = field(default_factory=list)
    rounds: int = 0
    change: float = 0.0

    def _pattern(self) -> Column:
        out = F.lit(0).cast("long")
        for i, c in enumerate(self.cols):
            out = out + F.when(_known(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0))
        return out

    def _map(self, pattern: int, steps: Sequence[tuple[int, np.ndarray]] | None = None) -> np.ndarray:
        """Rows: each column as a linear function of [1, columns with 0 for nulls]."""
        d = len(self.cols)
        a = np.eye(d + 1)
        for j in range(d):
            if pattern >> j & 1:
                a[j + 1] = 0.0
        for j, beta in self.steps if steps is None else steps:
            if pattern >> j & 1:
                a[j + 1] = beta @ a
        return a

    def transform(self, df: DataFrame) -> DataFrame:
        """Fills the null cells of all columns; other columns stay."""
        marked = df.withColumn("_pattern", self._pattern())
        patterns = sorted(r[0] for r in marked.select("_pattern").distinct().collect())  # at most 2^columns, those with nulls
        observed = [(F.coalesce(_known(c), F.lit(float(m))) - F.lit(float(m))) / F.lit(float(s)) for c, m, s in zip(self.cols, self.mean, self.scale, strict=True)]
        out = {}
        for j, c in enumerate(self.cols):
            value = None
            for p in patterns:
                if p >> j & 1:
                    w = self._map(p)[j + 1]
                    z = F.lit(float(w[0]))
                    for i in np.flatnonzero(w[1:]):
                        z = z + F.lit(float(w[i + 1])) * observed[i]
                    cell = z * F.lit(float(self.scale[j])) + F.lit(float(self.mean[j]))
                    value = F.when(F.col("_pattern") == p, cell) if value is None else value.when(F.col("_pattern") == p, cell)
            if value is not None:
                out[c] = F.coalesce(_known(c), value)
        return marked.withColumns(out).drop("_pattern")


def fit_chained(df: DataFrame, cols: Sequence[str], max_rounds: int = 10, tolerance: float = 1e-3) -> ChainedMoments:
    """Learns the rounds from ``df``; two aggregations (location and scale, then moments by pattern)."""
    first = df.agg(*[f(_known(c)).alias(f"{n}{i}") for i, c in enumerate(cols) for f, n in ((F.avg, "m"), (F.stddev_pop, "s"), (F.count, "k"))]).first()
    cols = [(i, c) for i, c in enumerate(cols) if first[f"k{i}"]]
    model = ChainedMoments([c for _, c in cols], np.array([first[f"m{i}"] for i, _ in cols]), np.array([first[f"s{i}"] or 1.0 for i, _ in cols]))
    d = len(model.cols)
    z = [(_known(c) - F.lit(float(m))) / F.lit(float(s)) for c, m, s in zip(model.cols, model.mean, model.scale, strict=True)]
    z = [F.coalesce(x, F.lit(0.0)).alias(f"z{i}") for i, x in enumerate(z)]
    rows = df.select(model._pattern().alias("p"), *z)
    sums = [F.sum(f"z{i}").alias(f"s{i}") for i in range(d)] + \
        [F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"q{i}_{j}") for i in range(d) for j in range(i, d)]
    moments: dict[int, np.ndarray] = {}
    for r in rows.groupBy("p").agg(F.count("*").alias("n"), *sums).collect():  # one row a pattern
        m = np.zeros((d + 1, d + 1))
        m[0, 0] = r["n"]
        for i in range(d):
            m[0, i + 1] = m[i + 1, 0] = r[f"s{i}"]
            for j in range(i, d):
                m[i + 1, j + 1] = m[j + 1, i + 1] = r[f"q{i}_{j}"]
        moments[r["p"]] = m
    missing = [sum(m[0, 0] for p, m in moments.items() if p >> j & 1) for j in range(d)]
    order = sorted((j for j in range(d) if missing[j]), key=lambda j: (missing[j], j))
    maps = {p: model._map(p) for p in moments}
    current = dict(moments)
    for p in moments:
        current[p] = maps[p] @ moments[p] @ maps[p].T
    for _ in range(max_rounds if order else 0):
        model.rounds += 1
        model.change = 0.0
        for j in order:
            total = sum((c for p, c in current.items() if not p >> j & 1), np.zeros((d + 1, d + 1)))
            others = [i for i in range(d + 1) if i != j + 1]
            beta = np.zeros(d + 1)
            beta[others] = np.linalg.pinv(total[np.ix_(others, others)], rcond=1e-10, hermitian=True) @ total[others, j + 1]
            model.steps.append((j, beta))
            for p in moments:
                if p >> j & 1:
                    new = beta @ maps[p]
                    moved = new - maps[p][j + 1]
                    model.change = max(model.change, float(np.sqrt(max(0.0, moved @ moments[p] @ moved) / moments[p][0, 0])))
                    maps[p] = maps[p].copy()
                    maps[p][j + 1] = new
                    current[p] = maps[p] @ moments[p] @ maps[p].T
        if model.change <= tolerance:
            break
    return model
