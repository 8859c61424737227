"""Boxes of points against brute force, and what masked neighbours shuffle."""

import numpy as np
from pyspark.sql import functions as F

from tabforge.operators import knn_masked
from tabforge.operators.boxes import Near, cut_boxes, first_of_equal
from tests.test_knn_masked import check, table


def points(n, seed):
    rng = np.random.default_rng(seed)
    return np.column_stack([rng.normal(0, 100, n).round(1), rng.integers(0, 3, n).astype(float), rng.integers(0, 50, n).astype(float)])


def test_nearest_points_with_ties():
    p = points(900, 1)
    ids = np.random.default_rng(2).permutation(len(p))
    own = first_of_equal(p, ids, 3)
    p, ids = p[own], ids[own]
    x = np.concatenate([points(200, 3), p[:100]])
    reach = np.where(np.arange(len(x)) % 3 == 0, 40.0, np.inf)
    row, point, d2 = Near(p, 1.5, 3)(x, reach)
    for i in range(len(x)):
        every = ((x[i] - p) ** 2).sum(axis=1) * 1.5
        want = [j for j in np.lexsort((ids, every))[:3] if every[j] <= reach[i]]
        assert point[row == i].tolist() == want and np.allclose(d2[row == i], every[want])


def test_equal_rows_stay_together():
    boxes, members = cut_boxes(np.array([[1.0, 2.0]] * 9 + [[1.0, 3.0]]), 4)
    assert sorted(map(len, members)) == [1, 9] and boxes.home(np.array([[1.0, 2.0], [1.0, 9.0]])).tolist() == [
        int(np.flatnonzero([len(m) == 9 for m in members])[0]), int(np.flatnonzero([len(m) == 1 for m in members])[0])]


def test_no_donor_is_complete(spark):
    rows = [r for r in table(500, 7, holes=0.35) if None in r]
    check(spark, rows, rows, cells_per_bucket=20)


def test_donors_are_copied_by_shared_coordinates_and_probes_meet_few_boxes(spark):
    """Not once a pattern and target, and no pair of a probe and a donor leaves its task but the k nearest of a box."""
    x = spark.range(40_000).select(F.col("id").alias("_pid"), *[F.when(F.col("id") % p != 0, F.rand(p) * s).alias(f"x{j}")
                                                                for j, (p, s) in enumerate([(5, 1000.0), (7, 9000.0), (11, 10.0)])])
    given = x.withColumn("_mask", knn_masked._mask(["x0", "x1", "x2"])).persist()
    counts = {r[0]: r[1] for r in given.groupBy("_mask").count().collect()}
    plan = knn_masked._plan(given, counts, sorted(set(counts) - {7}), 3, 5, 2_000)
    copies = given.mapInArrow(lambda b: plan.points(b, set(plan.keys)), knn_masked._PLACED).groupBy("_mask").count().collect()
    assert {r[0]: r[1] for r in copies}[7] <= 6 * counts[7]  # 9 patterns and targets
    asked = given.where("_mask = 6").mapInArrow(plan.first, knn_masked._PLACED)
    own = given.mapInArrow(lambda b: plan.points(b, {(7, 6)}), knn_masked._PLACED)
    bounded = own.unionByName(asked).repartition(3, "_box").sortWithinPartitions("_box", "_side").mapInArrow(plan.bound, knn_masked._ROWS).persist()
    assert bounded.where("_far < 'Infinity'").count() == counts[6]
    assert bounded.mapInArrow(plan.again, knn_masked._PLACED).count() < 8 * counts[6]
    given.unpersist()
    bounded.unpersist()
