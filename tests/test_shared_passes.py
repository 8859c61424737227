"""Model operators share their passes over folds and configurations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators.models import ModelSpec, evaluate, fit, oof_predictions, train_score

BOOST = [ModelSpec(f"g{i}", "gbt", {"n_rounds": 3, "max_depth": 2, "learning_rate": 0.1 * (i + 1)}) for i in range(3)]


@pytest.fixture(scope="module")
def frame(spark):
    x = spark.range(600).select("id", ((F.col("id") * 37) % 101).cast("double").alias("a"), ((F.col("id") * 11) % 17).cast("double").alias("b"))
    x = x.withColumn("label", ((F.col("a") + 3 * F.col("b") + F.col("id") % 9) > 75).cast("int")).withColumn("fold", (F.col("id") % 4).cast("int"))
    return x.persist()


def jobs(spark, name, work):
    spark.sparkContext.setJobGroup(name, name)
    work()
    n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    spark.sparkContext.setJobGroup("", "")
    return n


def test_jobs_do_not_grow_with_configurations_or_folds(spark, frame):
    one = jobs(spark, "one", lambda: evaluate(BOOST[:1], frame, ["a", "b"]).collect())
    three = jobs(spark, "three", lambda: evaluate(BOOST, frame, ["a", "b"]).collect())
    halves = frame.withColumn("fold", F.col("fold") % 2)
    two = jobs(spark, "two", lambda: oof_predictions(halves, BOOST[0], ["a", "b"]).collect())
    four = jobs(spark, "four", lambda: oof_predictions(frame, BOOST[0], ["a", "b"]).collect())
    assert three <= one + 3 and four <= two + 3


@pytest.mark.parametrize("kind,params", [("logreg", {"C": 0.1}), ("forest", {"n_trees": 5, "max_depth": 3}), ("gbt", {"n_rounds": 4}),
                                         ("rff", {"n_components": 8}), ("svm", {"n_landmarks": 8})])
def test_a_fitted_model_predicts_any_frame(spark, frame, kind, params):
    spec = ModelSpec("m", kind, params)
    got = fit(spec, frame, ["a", "b"]).predict(frame.drop("fold"))
    assert set(got.columns) >= {"id", "a", "b", "label", "proba", "pred"} and got.count() == 600
    accuracy = got.agg(F.avg((F.col("pred") == F.col("label")).cast("double")).alias("v")).first()["v"]
    assert accuracy == pytest.approx(train_score(spec, frame, ["a", "b"]).first()["train_score"], abs=1e-9 if kind != "rff" else 5e-3)
    with pytest.raises(Exception, match="null"):
        fit(spec, frame.withColumn("a", F.when(F.col("id") > 3, F.col("a"))), ["a", "b"])


class Rows:
    """Rows in the form of a block."""

    def __init__(self, n, d):
        rng = np.random.default_rng(5)
        self.raw, self.labels, self.keys = rng.normal(size=(n, d)), rng.integers(0, 2, n), rng.integers(0, 1 << 60, n).astype(np.uint64)
        self.splits = {"fold": rng.integers(0, 3, n)}

    def trains(self, conditions):
        return np.all([self.splits[c] != v for c, v in conditions] or [np.ones(len(self.raw), bool)], axis=0)


def test_shared_sums_equal_those_of_each_fit():
    from tabforge.training import fits, svm

    block, rng = Rows(9_000, 3), np.random.default_rng(1)
    own = [(k, (("fold", k % 3),) if k % 2 else (), rng.normal(size=4)) for k in range(6)]
    for part in (own, own[:2]):
        for k, got in fits._Logistic([((0, 1, 2), part)])(block):
            _, c, w = own[k]
            rows = block.trains(c)
            x, y = np.column_stack([block.raw[rows], np.ones(rows.sum())]), block.labels[rows]
            p = 1 / (1 + np.exp(-x @ w))
            want = np.concatenate([[np.logaddexp(0, x @ w).sum() - y @ (x @ w)], x.T @ (p - y), ((x * (p * (1 - p))[:, None]).T @ x).ravel()])
            assert np.allclose(got, want, rtol=1e-9, atol=1e-6)
    kernel = svm.KernelMap((0, 1, 2), np.zeros(3), np.ones(3), block.raw[:6], np.eye(6), 0.3)
    f = fits.Fit(ModelSpec("s", "svm"), (0, 1, 2), (("fold", 1),))
    tasks = [(i, svm._Task(f, kernel, rng.normal(size=7) * 0.4, i - 1)) for i in range(svm.INNER + 1)]
    for k, got in svm._Hinge(tasks)(block):
        t = tasks[k][1]
        rows = block.trains(f.conditions) & (t.part(block.keys) != t.inner)
        z, y = kernel(block.raw[rows]), 2.0 * block.labels[rows] - 1
        slack = np.maximum(1 - y * (z @ t.weights), 0)
        a = z[slack > 0]
        assert np.allclose(got, np.concatenate([[(slack ** 2).sum()], -2 * z.T @ (y * slack), (2 * a.T @ a).ravel()]), rtol=1e-9, atol=1e-6)


def test_rules_of_forests_as_counts():
    from tabforge.operators.models import _with_counts

    got = _with_counts(ModelSpec("f", "forest", {"n_trees": 2, "min_samples_split": 5}), 8).params
    assert got == {"n_trees": 2, "min_samples_split": 5, "max_features": 3, "min_samples_leaf": 3}
    assert _with_counts(ModelSpec("f", "forest", {"max_features": "log2"}), 8).params["max_features"] == 3
    assert _with_counts(ModelSpec("f", "forest", {"max_features": "all"}), 8).params["max_features"] == "all"
