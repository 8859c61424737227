"""Nystroem kernel machines against the exact kernel solution; probabilities are calibrated on rows the margins did not see."""

import numpy as np
import pandas as pd
import pytest

from tabforge.operators.models import ModelSpec
from tabforge.training import blocks, fits, svm


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(8)
    x = pd.DataFrame({"id": np.arange(600), "a": rng.normal(size=600) * 5, "b": rng.normal(size=600) + 100})
    inside = (x.a / 5) ** 2 + (x.b - 100) ** 2 < 1.3
    x["label"], x["fold"] = np.where(rng.random(600) < 0.05, ~inside, inside).astype(int), np.arange(600) % 3
    return x


def exact_margins(train, test, y, gamma, c):
    """Squared-hinge kernel machine with an intercept, by Newton steps on all rows."""
    def kernel(u, v):
        return np.exp(-gamma * ((u[:, None] - v[None]) ** 2).sum(-1))

    k = kernel(train, train)
    alpha, b, s = np.zeros(len(train)), 0.0, 2.0 * y - 1
    for _ in range(40):
        live = s * (k @ alpha + b) < 1
        n = int(live.sum())
        m = np.zeros((n + 1, n + 1))
        m[:n, :n] = k[np.ix_(live, live)] + np.eye(n) / (2 * c)
        m[:n, n] = m[n, :n] = 1.0
        sol = np.linalg.solve(m, np.append(s[live], 0.0))
        alpha, b = np.zeros(len(train)), sol[n]
        alpha[live] = sol[:n]
    return kernel(test, train) @ alpha + b


def test_svm_equals_exact_solution(spark, table):
    packed = blocks.pack(spark.createDataFrame(table), ["a", "b"], ["fold"])
    own = fits.cross_fits(packed, [ModelSpec("svm", "svm", {"C": 1.0, "n_landmarks": 64})], ["a", "b"], [0, 1, 2])
    fitted = fits.fit_all(packed, own)
    raw = table[["a", "b"]].to_numpy()
    assert svm.kernel_error(fitted.models[0].map, raw) < 0.02
    train, test = table[table.fold != 0], table[table.fold == 0]
    x = train[["a", "b"]].to_numpy()
    scaled = [(t[["a", "b"]].to_numpy() - x.mean(axis=0)) / x.std(axis=0) for t in (train, test)]
    want = exact_margins(scaled[0], scaled[1], train["label"].to_numpy(), 0.5, 1.0)
    got = fitted.models[0].margin(test[["a", "b"]].to_numpy())
    assert np.corrcoef(got, want)[0, 1] > 0.99 and ((got > 0) == (want > 0)).mean() > 0.97
    rows = pd.DataFrame(fits.predictions(packed, fitted).where("fit < 3").collect(), columns=["id", "fit", "label", "proba"])
    assert len(rows) == 600 and ((rows.proba > 0.5) == rows.label).mean() > 0.88
    for low, high in ((0.0, 0.3), (0.7, 1.0)):
        part = rows[(rows.proba >= low) & (rows.proba <= high)]
        assert abs(part.proba.mean() - part.label.mean()) < 0.08  # calibrated where it is sure
    assert rows.proba.between(0, 1).all()


def test_repeated_and_constant_rows(spark):
    flat = spark.createDataFrame([(i, 1.0, float(i % 2), i % 2, i % 3) for i in range(30)], "id long, a double, b double, label int, fold int")
    got = fits.oof_table(flat, [ModelSpec("s", "svm", {})], ["a", "b"]).collect()
    assert len(got) == 30 and all(r["pred"] == r["label"] for r in got)
    nulls = spark.createDataFrame([(1, None, 1, 0), (2, 1.0, 0, 1)], "id long, a double, label int, fold int")
    with pytest.raises(ValueError):
        fits.oof_table(nulls, [ModelSpec("s", "svm", {})], ["a"])
