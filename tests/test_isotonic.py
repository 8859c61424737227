"""Isotonic values equal the plain pooling of all points, however the scores are dealt."""

import numpy as np
import pytest

from tabforge.operators.isotonic import isotonic_values


def brute(points):
    """Max over starts of the min over ends of the mean."""
    xs = sorted({x for x, _ in points})
    out = {}
    for i, x in enumerate(xs):
        out[x] = max(min(np.mean([y for p, y in points if xs[a] <= p <= xs[b]]) for b in range(i, len(xs))) for a in range(i + 1))
    return out


@pytest.mark.parametrize("parts", [1, 3, 11])
def test_values_equal_max_min(spark, parts):
    rng = np.random.default_rng(1)
    rows = [(k, round(float(x), 2), int(rng.random() < x * s)) for k, s, n in (("a", 1.0, 120), ("b", 0.3, 60)) for x in rng.random(n)]
    rows += [("c", 0.5, 1), ("c", 0.1, 1)]
    got = isotonic_values(spark.createDataFrame(rows, "k string, x double, y int"), "k", "x", "y", parts).collect()
    for key in "abc":
        want = brute([(x, y) for k, x, y in rows if k == key])
        own = {r["score"]: r["value"] for r in got if r["key"] == key}
        assert own.keys() == want.keys() and all(abs(own[x] - v) < 1e-12 for x, v in want.items())


@pytest.mark.parametrize("parts", [1, 4])
def test_scores_without_label_take_the_block_before(spark, parts):
    rows = [("a", 0.2, 0), ("a", 0.4, 1), ("a", 0.6, 0), ("a", 0.8, 1), ("a", 0.1, None), ("a", 0.3, None), ("a", 0.5, None), ("a", 0.7, None),
            ("a", 0.9, None), ("b", 0.5, None), (None, 0.5, 1), ("a", None, 1)]
    got = {(r["key"], r["score"]): r["value"] for r in
           isotonic_values(spark.createDataFrame(rows, "k string, x double, y int"), "k", "x", "y", parts).collect()}
    assert got == {("a", 0.1): 0.0, ("a", 0.2): 0.0, ("a", 0.3): 0.0, ("a", 0.4): 0.5, ("a", 0.5): 0.5, ("a", 0.6): 0.5, ("a", 0.7): 0.5,
                   ("a", 0.8): 1.0, ("a", 0.9): 1.0, ("b", 0.5): None}
    assert isotonic_values(spark.createDataFrame([], "k string, x double, y int"), "k", "x", "y").count() == 0
