"""Chained imputation from moments against round-by-round least squares; VIFs and elimination against regressions."""

import math

import numpy as np
import pandas as pd
import pytest

from tabforge.operators.chained import fit_chained
from tabforge.operators.profile import eliminate_collinear, vif


def brute_chain(x, rounds):
    """Each column with nulls, fewest first, regressed on all others over its observed rows; null cells take the prediction."""
    gone = np.isnan(x)
    z = np.where(gone, np.nanmean(x, axis=0), x)
    order = sorted((j for j in range(x.shape[1]) if gone[:, j].any()), key=lambda j: (gone[:, j].sum(), j))
    for _ in range(rounds):
        for j in order:
            a = np.column_stack([np.ones(len(z)), np.delete(z, j, axis=1)])
            beta = np.linalg.lstsq(a[~gone[:, j]], z[~gone[:, j], j], rcond=None)[0]
            z[gone[:, j], j] = a[gone[:, j]] @ beta
    return z


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(11)
    base = rng.normal(size=(300, 2))
    x = np.column_stack([base[:, 0] * 50 + 1000, base @ [1.0, 2.0] + rng.normal(size=300) * 0.3, base[:, 1] * 0.01, rng.integers(0, 5, 300)]).astype(float)
    hole = rng.random(x.shape) < [0.2, 0.15, 0.3, 0.0]
    return np.where(hole, np.nan, x)


def as_frame(spark, x):
    rows = [(i, *[None if math.isnan(v) else float(v) for v in r], "keep") for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"c{j} double" for j in range(x.shape[1])) + ", other string")


def test_chain_equals_least_squares(spark, table):
    df = as_frame(spark, table)
    cols = [f"c{j}" for j in range(4)]
    model = fit_chained(df, cols, max_rounds=7, tolerance=0.0)
    got = pd.DataFrame(model.transform(df).select("id", *cols).collect(), columns=["id", *cols]).sort_values("id")[cols].to_numpy(float)
    want = brute_chain(table, 7)
    assert model.rounds == 7 and len(model.steps) == 21
    assert np.abs((got - want) / np.nanstd(table, axis=0)).max() < 1e-8
    early = fit_chained(df, cols, max_rounds=50, tolerance=5e-3)
    assert early.rounds < 50 and early.change <= 5e-3


def test_chain_odd_columns(spark):
    df = spark.createDataFrame([(1, 2.0, None, 5.0, 1.0), (2, None, None, 5.0, 2.0), (3, 4.0, None, None, 3.0), (4, float("nan"), None, 5.0, 4.0)],
                               "id long, a double, gone double, flat double, b double")
    got = {r["id"]: r for r in fit_chained(df, ["a", "gone", "flat", "b"]).transform(df).collect()}
    assert got[3]["flat"] == 5.0 and all(r["gone"] is None for r in got.values())
    assert abs(got[2]["a"] - 3.0) < 1e-9 and abs(got[4]["a"] - 5.0) < 1e-9
    assert fit_chained(df, ["b"]).transform(df).count() == 4


def test_vif_of_constant_and_exact_combinations(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 3))
    rows = [(float(a), float(b), float(c), 7.0, float(a - 2 * b)) for a, b, c in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, flat double, both double")
    got = {r["feature"]: r["vif"] for r in vif(df, ["a", "b", "c", "flat"]).collect()}
    assert got["flat"] == math.inf
    for j, c in enumerate("abc"):
        a = np.column_stack([np.ones(200), np.delete(x, j, axis=1)])
        rest = x[:, j] - a @ np.linalg.lstsq(a, x[:, j], rcond=None)[0]
        assert abs(got[c] - x[:, j].var() / rest.var()) < 1e-9
    got = {r["feature"]: r["vif"] for r in vif(df, ["a", "b", "c", "both"]).collect()}
    assert got["a"] == got["b"] == got["both"] == math.inf and got["c"] < 2
    steps = {r["feature"]: (r["step"], r["action"]) for r in eliminate_collinear(df, ["a", "b", "c", "flat", "both"]).collect()}
    assert steps == {"flat": (1, "drop"), "both": (2, "drop"), "a": (0, "keep"), "b": (0, "keep"), "c": (0, "keep")}
