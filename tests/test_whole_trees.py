"""Trees and boosted models grown whole in a task equal those counted level by level, in a few jobs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabforge.operators.models import ModelSpec
from tabforge.training import blocks, fits, whole

FEATURES = ["a", "b", "c"]
SPECS = [ModelSpec("f", "forest", {"n_trees": 7, "max_depth": 6}),
         ModelSpec("r", "forest", {"n_trees": 4, "max_depth": 4, "bootstrap": False, "max_features": "all"}),
         ModelSpec("s", "forest", {"n_trees": 3, "max_depth": 4, "bootstrap": False, "max_features": "log2"}),
         ModelSpec("g", "gbt", {"n_rounds": 7, "max_depth": 3}),
         ModelSpec("gs", "gbt", {"n_rounds": 9, "max_depth": 2, "subsample": 0.7, "max_features": "sqrt", "min_leaf": 4}),
         ModelSpec("x", "xgb", {"n_rounds": 6, "max_depth": 3, "l1": 0.1, "min_gain": 0.05, "colsample": 0.7, "subsample": 0.8}),
         ModelSpec("l", "leafwise", {"n_rounds": 5, "num_leaves": 6, "min_leaf": 5}),
         ModelSpec("lr", "logreg", {"C": 1.0})]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(8)
    n = 1_500
    x = pd.DataFrame({"id": np.arange(n) // 2, "a": rng.normal(size=n).round(1), "b": rng.integers(0, 6, n).astype(float), "c": rng.normal(size=n).round(1)})
    x["label"], x["fold"], x["other"] = (x.a - (x.b == 2) + rng.normal(size=n) > 0).astype(int), np.arange(n) % 4, rng.integers(0, 3, n)
    df = spark.createDataFrame(x)
    return df.withColumn("a", F.when(F.rand(5) > 0.1, F.col("a"))).withColumn("other", F.when(F.col("id") % 50 > 0, F.col("other"))).persist()


def made(packed, specs):
    own = [f for s in specs for every in [(0, 1, 2) if s.kind != "logreg" else (2, 1)]  # "a" has nulls
           for f in (fits.Fit(s, every, ()), fits.Fit(s, every, (("fold", 1),)), fits.Fit(s, (2, 1), (("fold", 2), ("other", 0))))]
    fitted = fits.fit_all(packed, own)
    rows = {(r["fit"], r["id"], r["proba"]) for r in fits.predictions(packed, fitted).collect()}
    rows |= {tuple(r) for r in fits.fit_scores(packed, fitted).collect()}
    return rows, [fitted.importances(i, 3) for i, f in enumerate(own) if f.spec.kind != "logreg"]


def test_whole_trees_equal_those_counted_level_by_level(spark, frame, monkeypatch):
    monkeypatch.setattr(blocks, "LEAST_ROWS", 100)
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 150)
    packed = blocks.pack(frame, FEATURES, ["fold", "other"], max_bins=32)
    got, gains = made(packed, SPECS)
    assert isinstance(packed.table, whole.Table) and packed.table.counts.sum() == 1_500
    monkeypatch.setattr(whole, "DRAWN_AT_ONCE", 4_000)  # a few draws a job
    assert made(packed, SPECS)[0] == got
    monkeypatch.setattr(whole, "EXACT_ROWS", 1)  # as in tables of many rows
    monkeypatch.setattr(whole, "BOTH", 0)
    assert made(packed, SPECS)[0] == got
    for bound in ("ENTRIES_IN_A_TASK", "CELLS_IN_A_TASK"):
        with monkeypatch.context() as m:
            m.setattr(whole, bound, 10)
            packed.table = None
            want, counted = made(packed, SPECS)
            assert packed.table is False and want == got
            assert all(np.allclose(a, b) for a, b in zip(gains, counted, strict=True))


def test_jobs_do_not_grow_with_levels_or_rounds(spark, frame):
    def jobs(name, specs):
        packed = blocks.pack(frame, FEATURES, ["fold", "other"], max_bins=32)
        spark.sparkContext.setJobGroup(name, name)
        fits.fit_all(packed, [fits.Fit(s, (0, 1, 2), (("fold", k),)) for s in specs for k in range(4)])
        n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        spark.sparkContext.setJobGroup("", "")
        return n

    assert jobs("whole", SPECS[:-1]) <= 14  # a job a level and round before: over 60


def test_a_block_of_many_rows_counts_exactly(spark):
    """Sums of gradients beyond 2**53 are whole."""
    n, g = np.array([1 << 25, 3]), np.array([(1 << 30) - 1, 5])
    finder = whole.Finder(np.array([[1, 2]], dtype=np.uint8), np.array([0]), 4, [n, n * g, n * 7], "newton")
    got = finder._added(np.array([1, 1]), [s for s, _ in finder.channels], 4)
    assert [int(x[1]) for x in got] == [int(n.sum()), int((n * g).sum()), int((n * 7).sum())]
    assert int(whole._whole_sums(np.array([0, 0]), n * g, 1, 1 << 25)[0]) == int((n * g).sum())


def test_a_frame_is_packed_once_for_all_that_share_it(spark, frame, monkeypatch):
    from tabforge.operators.models import fit, oof_predictions, train_score

    made, bin_edges = [], blocks.bin_edges
    monkeypatch.setattr(blocks, "bin_edges", lambda *a: made.append(a) or bin_edges(*a))
    spec, linear, some = ModelSpec("g", "gbt", {"n_rounds": 3}), ModelSpec("lr", "logreg", {"C": 1.0}), ["c", "b"]

    def tables():
        oof = oof_predictions(frame, spec, some).collect(), oof_predictions(frame, linear, some).collect()
        return sorted(oof[0]), [(r["id"], round(r["proba"], 9)) for r in sorted(oof[1])], train_score(spec, frame, some).collect(), fit(spec, frame, some).weights.tolist()

    alone = tables()
    assert len(made) == 3
    with blocks.packed_once(frame, some, ["fold"]):
        assert tables() == alone and len(made) == 4
        with pytest.raises(Exception, match="null"):  # another list of features is packed by itself
            fit(spec, frame, ["a", "b"])
    with blocks.packed_once(frame, FEATURES, ["fold"]), pytest.raises(Exception, match="null"):
        fit(spec, frame, FEATURES)
    assert not blocks._SHARED


def test_votes_leave_the_blocks_as_a_row_an_id(spark, frame):
    """Two rows of each id, in the same fold or not: their votes are one ballot where fold and label agree. Computed from all predictions."""
    packed = blocks.pack(frame, ["c", "b"], ["fold", "other"])
    specs = [ModelSpec("f", "forest", {"n_trees": 3, "max_depth": 3}), ModelSpec("g", "gbt", {"n_rounds": 3}), ModelSpec("lr", "logreg", {"C": 1.0})]
    own = [f for s in specs for f in (fits.Fit(s, (0, 1), (("fold", 1),)), fits.Fit(s, (0, 1), (("other", 2),)), fits.Fit(s, (0, 1)))]
    fitted = fits.fit_all(packed, own)
    got = {r["fit"]: (r["n"], r["hits"]) for r in fits.ballots(packed, fitted).collect()}
    cast = {}
    for r in fits.predictions(packed, fitted).collect():
        cast.setdefault((r["fit"] % 3, r["id"], r["label"]), []).append(r["proba"] >= 0.5)
    want = {i: [int((2 * sum(v) > len(v)) == bool(k[2])) for k, v in cast.items() if k[0] == i] for i in range(3)}
    assert got == {i: (len(w), sum(w)) for i, w in want.items()}
    shapes = [fits.ballots(packed, fits.Fitted(own[:k], fitted.models[:k]))._jdf.queryExecution().optimizedPlan().toString() for k in (3, 9)]
    assert all("Join" not in s and "Expand" not in s for s in shapes)
