"""Equal rows are counted once: cells of a block, scores counted within blocks, one value map for many quantiles."""

import numpy as np
from pyspark.sql import functions as F

from tabforge.operators.models import ModelSpec, cv_summary
from tabforge.operators.quantiles import group_quantiles
from tabforge.training import blocks, fits, trees


def _frame(spark, n=600):
    i = F.col("id")
    return spark.range(n).select("id", (i % 4).cast("double").alias("a"), F.when(i % 5 > 0, (i % 3).cast("double")).alias("b"),
                                 (i % 4 + i % 7 > 4).cast("int").alias("label"), (i % 2).cast("int").alias("fold"))


def test_equal_rows_are_one_cell(spark):
    packed = blocks.pack(_frame(spark), ["a", "b"], ["fold"])
    rows = packed.frame.select("n", "cell_counts", "cell_of", "keys", "cell_bins", "cell_labels", "cell_splits").toArrow().to_batches()
    own = [blocks.cells_of(b.slice(i, 1), ["fold"], 2) for b in rows for i in range(b.num_rows)]
    assert sum(int(c.counts.sum()) for c in own) == 600 and max(len(c) for c in own) <= 32
    assert all((np.bincount(c.cell_of) == c.counts).all() for c in own)
    plan = trees.TreePlan(0, 3, (), (0, 1), bootstrap=True)
    for c in own:  # a cell is drawn as often as its rows
        times = np.searchsorted(trees._POISSON, blocks.uniform(c.keys, 3), side="right")
        assert [int(times[c.cell_of == k].sum()) for k in range(len(c))] == trees.drawn(c, plan).tolist()
    packed.release()


def test_counted_scores_equal_those_of_the_rows(spark):
    packed = blocks.pack(_frame(spark), ["a", "b"], ["fold"])
    every = fits.cross_fits(packed, [ModelSpec("f", "forest", {"n_trees": 3, "max_depth": 2}), ModelSpec("x", "xgb", {"n_rounds": 3})], ["a", "b"], [0, 1])
    fitted = fits.fit_all(packed, every)
    want = {r["model"]: r for r in cv_summary(fits.named(fits.predictions(packed, fitted), every).where("fold >= 0")).collect()}
    got = {r["model"]: r for r in fits.scores_summary(fits.fit_scores(packed, fitted)).collect()}
    assert got.keys() == want.keys() and all(abs(got[m][c] - want[m][c]) < 1e-12 for m in want for c in ("cv_score", "cv_std", "oof_score"))
    packed.release()


def test_many_quantiles_share_one_map(spark):
    from unittest import mock
    from tabforge.operators import quantiles
    df = _frame(spark)
    probs = [i / 64 for i in range(65)]
    with mock.patch.object(quantiles.F, "percentile", wraps=F.percentile) as calls:
        got = group_quantiles(df, "b", probs, ["label"], strategy="percentile").collect()
    assert calls.call_count == 1 and len(got) == 2
    for r in got:
        one = df.where(F.col("label") == r["label"]).agg(F.percentile("b", 0.5).alias("m")).first()["m"]
        assert r["q0_5"] == one
