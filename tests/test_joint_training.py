"""Joint training: what is trained along changes nothing, splits equal brute force and SQL, searches and stacks are sound."""

import math

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabforge.operators.models import ModelSpec, evaluate
from tabforge.training import blocks, fits, trees
from tabforge.training.search import Trial, random_params, run_search

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(3)
    n = 400
    x = pd.DataFrame({"id": np.arange(n), "a": rng.normal(size=n).round(2), "b": rng.integers(0, 6, n).astype(float), "c": rng.normal(size=n).round(1)})
    z = 1.5 * x.a - (x.b == 2) * 2 + np.sin(2 * x.c) + rng.normal(size=n) * 0.5
    x["label"], x["fold"] = (z > 0).astype(int), np.arange(n) % 4
    x.loc[rng.random(n) < 0.15, "a"] = np.nan
    return x


@pytest.fixture(scope="module")
def frame(spark, table):
    df = spark.createDataFrame(table)
    return df.withColumn("a", F.when(~F.isnan("a"), F.col("a")))


@pytest.fixture(scope="module")
def packed(frame):
    return blocks.pack(frame, FEATURES, ["fold"], max_bins=32)


SPECS = [ModelSpec("f", "forest", {"n_trees": 7, "max_depth": 4}), ModelSpec("g", "gbt", {"n_rounds": 12, "max_depth": 2, "subsample": 0.8}),
         ModelSpec("x", "xgb", {"n_rounds": 5, "max_depth": 3, "l1": 0.1, "min_gain": 0.05, "colsample": 0.7}),
         ModelSpec("l", "leafwise", {"n_rounds": 4, "num_leaves": 6, "min_leaf": 5})]


def probas(packed, fitted):
    return {(r["fit"], r["id"]): r["proba"] for r in fits.predictions(packed, fitted).collect()}


def test_joint_fits_equal_single_fits(packed):
    every = fits.cross_fits(packed, SPECS, FEATURES, [0, 1])
    together = probas(packed, fits.fit_all(packed, every))
    for i in (0, 2, 3, 4, 7, 9):
        alone = probas(packed, fits.fit_all(packed, [every[i]]))
        assert alone and all(together[i, k] == v for (_, k), v in alone.items())


def test_partitions_do_not_show(packed, frame, monkeypatch):
    own = fits.cross_fits(packed, SPECS, FEATURES, [0])
    want = probas(packed, fits.fit_all(packed, own))
    monkeypatch.setattr(blocks, "LEAST_ROWS", 50)
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 30)
    monkeypatch.setattr(trees, "PAIRS_PER_TASK", 1)
    monkeypatch.setattr(trees, "CELLS_PER_TASK", 100)
    monkeypatch.setattr(fits, "TREES_AT_ONCE", 5)
    monkeypatch.setattr(fits, "ROUNDS_PER_STATE", 3)
    small = blocks.pack(frame.repartition(5), FEATURES, ["fold"], max_bins=32)
    assert small.n_parts > 5
    got = probas(small, fits.fit_all(small, own))
    assert got.keys() == want.keys() and all(abs(got[k] - v) < 1e-12 for k, v in want.items())


def codes(packed, table):
    return blocks.bin_codes(table[FEATURES].to_numpy(float), packed.edges)


def brute_best(x, g, h, rows, l2, least):
    """Best (gain, feature, cut, nulls left) of a node, by trying everything."""
    def score(part):
        return g[part].sum() ** 2 / (h[part].sum() + l2)

    best = (1e-12, -1, -1, False)
    for f in range(x.shape[1]):
        sides = (False, True) if (x[rows] == 0).any() else (False,)
        for null_left in sides:
            for cut in range(1, x.max() + 1):
                to_left = np.where(x[rows, f] == 0, null_left, x[rows, f] <= cut)
                left, right = rows[to_left], rows[~to_left]
                if min(len(left), len(right)) >= least:
                    gain = 0.5 * (score(left) + score(right) - score(rows))
                    if gain > best[0] + 1e-9:
                        best = (gain, f, cut, null_left)
    return best


def test_leafwise_tree_equals_brute_force(packed, table):
    """200 rows, one boosting round: the splits in best-first order, chosen by exhaustive search."""
    x, y = codes(packed, table)[:200], table["label"].to_numpy()[:200]
    small = blocks.pack(packed.frame.sparkSession.createDataFrame(table[:200]), FEATURES, ["fold"], edges=packed.edges)
    p = y.mean()
    g = np.rint((p - y) * trees.UNIT) / trees.UNIT
    h = np.full(200, p * (1 - p))
    queue, chosen = {1: (np.arange(200), brute_best(x, g, h, np.arange(200), 1.0, 5))}, {}
    while len(chosen) < 6:
        path, (rows, best) = max(queue.items(), key=lambda kv: (kv[1][1][0], -kv[0]))
        if best[1] < 0:
            break
        del queue[path]
        chosen[path] = best
        to_left = np.where(x[rows, best[1]] == 0, best[3], x[rows, best[1]] <= best[2])
        for child, part in ((2 * path, rows[to_left]), (2 * path + 1, rows[~to_left])):
            queue[child] = (part, brute_best(x, g, h, part, 1.0, 5))
    plan = trees.TreePlan(0, 1, (), (0, 1, 2), "newton", 60, 7, 2, 5, l2=1.0)
    got = trees.grow(small, small.frame, [plan], fits.Margins(np.array([math.log(p / (1 - p))]), []))
    inner = np.flatnonzero(got.cut >= 0)
    assert {int(got.path[i]) for i in inner} == set(chosen)
    for i in inner:
        gain, f, cut, null_left = chosen[int(got.path[i])]
        assert got.feature[i] == f and abs(got.gain[i] - gain) < 1e-6
        inside = np.flatnonzero(x[:, f] > 0)
        assert ((x[inside, f] <= got.cut[i]) == (x[inside, f] <= cut)).all() or abs(got.gain[i] - gain) < 1e-9


def test_split_gains_equal_sql(packed, table):
    """Second-order gains of all root cuts: histograms and prefix sums in DuckDB."""
    x, y = codes(packed, table), table["label"].to_numpy()
    p = y.mean()
    con = duckdb.connect()
    con.register("t", pd.DataFrame({"b0": x[:, 0], "b1": x[:, 1], "b2": x[:, 2], "g": p - y, "h": np.full(len(y), p * (1 - p))}))
    sql = " UNION ALL ".join(f"SELECT {f} AS f, b{f} AS b, sum(g) AS g, sum(h) AS h, count(*) AS n FROM t GROUP BY b{f}" for f in range(3))
    best = con.sql(f"""
        WITH s AS ({sql}),
        k AS (SELECT f, b, sum(g) OVER w AS g, sum(h) OVER w AS h, sum(n) OVER w AS n FROM s WHERE b > 0 WINDOW w AS (PARTITION BY f ORDER BY b)),
        z AS (SELECT f, coalesce(sum(g) FILTER (WHERE b = 0), 0) AS g, coalesce(sum(h) FILTER (WHERE b = 0), 0) AS h,
                     coalesce(sum(n) FILTER (WHERE b = 0), 0) AS n, sum(g) AS tg, sum(h) AS th, sum(n) AS tn FROM s GROUP BY f),
        c AS (SELECT k.f, k.b, s AS null_left, k.g + s * z.g AS g, k.h + s * z.h AS h, k.n + s * z.n AS n, tg, th, tn
              FROM k JOIN z ON k.f = z.f, (VALUES (0), (1)) AS v(s))
        SELECT f, max(0.5 * (greatest(abs(g) - 0.3, 0) ^ 2 / (h + 2) + greatest(abs(tg - g) - 0.3, 0) ^ 2 / (th - h + 2)
                             - greatest(abs(tg) - 0.3, 0) ^ 2 / (th + 2)) - 0.01) AS gain
        FROM c WHERE n >= 5 AND tn - n >= 5 AND h >= 3 AND th - h >= 3 GROUP BY f""").fetchall()
    start = fits.Margins(np.array([math.log(p / (1 - p))]), [])
    for f, gain in best:
        plan = trees.TreePlan(0, 1, (), (f,), "newton", 4, 0, 2, 5, 3.0, 0.01, 0.3, 2.0)
        got = trees.grow(packed, packed.frame, [plan], start)
        assert abs(got.gain[0] - gain) < 1e-6 and got.depth.max() <= 4
    assert len(best) == 3


def test_linear_models_equal_spark_ml(frame):
    filled = frame.fillna(0.0)
    specs = [ModelSpec("l2", "logreg", {"C": 0.3, "max_iter": 1000}), ModelSpec("en", "logreg", {"C": 0.2, "l1_ratio": 0.5, "max_iter": 2000})]
    want = {r["model"]: r for r in evaluate(specs, filled, FEATURES).collect()}
    got = {r["model"]: r for r in fits.cv_table(filled, specs, {"all": FEATURES}).collect()}
    for m in want:
        for c in ("cv_score", "cv_std", "oof_score", "train_score"):
            assert abs(got[m][c] - want[m][c]) < 6e-3, (m, c)
    l1 = fits.fit_all(blocks.pack(filled, FEATURES, ["fold"]), [fits.Fit(ModelSpec("z", "logreg", {"C": 1e-4, "l1_ratio": 1.0}), (0, 1, 2))])
    assert np.abs(l1.models[0].weights[:-1]).max() == 0.0
    with pytest.raises(ValueError):
        fits.cv_table(frame, specs[:1], {"all": FEATURES})


def test_rungs_of_a_forest_add_up(packed):
    spec = {"n_trees": 6, "max_depth": 3}
    whole = fits.fit_all(packed, [fits.Fit(ModelSpec("f", "forest", spec), (0, 1, 2), (("fold", 0),))])
    parts = [fits.fit_all(packed, [fits.Fit(ModelSpec("f", "forest", spec | {"first_tree": a, "n_trees": n}), (0, 1, 2), (("fold", 0),))])
             for a, n in ((0, 2), (2, 4))]
    both = fits.Fitted(whole.fits, [fits.joined([p.models[0] for p in parts])])
    assert probas(packed, both) == probas(packed, whole)


def test_constant_features_and_one_class(spark):
    flat = spark.createDataFrame([(i, 1.0, None, i % 2, i % 2) for i in range(20)], "id long, a double, b double, label int, fold int")
    got = fits.oof_table(flat, SPECS, ["a", "b"]).collect()
    assert len(got) == 20 * len(SPECS) and all(0 <= r["proba"] <= 1 for r in got)


def test_stacking_never_sees_the_held_out_labels(frame):
    filled = frame.fillna(0.0)
    bases = [ModelSpec("a", "logreg", {"C": 0.1}), ModelSpec("b", "forest", {"n_trees": 3, "max_depth": 2})]
    metas = [(ModelSpec("plain", "logreg", {"C": 1.0}), []), (ModelSpec("pass", "logreg", {"C": 1.0}), FEATURES)]

    def first_fold(x):
        rows = fits.stacked_table(x, bases, metas, FEATURES, inner_folds=2).where("fold = 0").collect()
        return {(r["model"], r["id"]): round(r["proba"], 6) for r in rows}

    got = first_fold(filled)
    assert len(got) == 2 * 100
    flipped = filled.withColumn("label", F.when(F.col("fold") == 0, 1 - F.col("label")).otherwise(F.col("label")))
    assert first_fold(flipped) == got


SPACE = {"x": ("float", -5.0, 5.0), "lr": ("log", 1e-4, 1.0), "k": ("int", 1, 50), "m": ("cat", ["u", "v", "w"])}


def objective(p):
    return -(p["x"] - 1.3) ** 2 - (math.log10(p["lr"]) + 2) ** 2 - ((p["k"] - 20) / 10) ** 2 - (p["m"] != "v") * 2


def test_search_beats_random_draws():
    def evaluate_all(trials):
        for t in trials:
            t.score = objective(t.params)

    won = 0
    for seed in range(5):
        found = max(t.score for t in run_search(SPACE, evaluate_all, 50, seed=seed))
        drawn = max(objective(random_params(SPACE, seed, i)) for i in range(50))
        won += found > drawn
    assert won >= 4
    a, b = (run_search(SPACE, evaluate_all, 30, seed=9) for _ in range(2))
    assert [t.params for t in a] == [t.params for t in b]
    assert all(-5 <= t.params["x"] <= 5 and 1e-4 <= t.params["lr"] <= 1 and 1 <= t.params["k"] <= 50 for t in a)
    assert isinstance(a[0], Trial)
