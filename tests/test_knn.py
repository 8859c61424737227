"""Exact KNN imputation equals brute force, including probes that need the
second (radius) round and tied / duplicated donor vectors."""

import random

import numpy as np

from tabforge.operators.knn import knn_impute


def test_knn_matches_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(400):
        x = [float(rnd.choice([0, 1, 2])), round(rnd.gauss(0, 3), 1), float(rnd.randint(0, 3))]
        if i % 9 == 0:
            x = [1.0, 0.0, 2.0]  # duplicated vector
        t = None if i % 5 == 0 else round(rnd.uniform(0, 80), 2)
        rows.append((i, t, *x))
    df = spark.createDataFrame(rows, "id long, t double, a double, b double, c double")
    got = {r["id"]: r["t"] for r in knn_impute(df, df, "id", "t", ["a", "b", "c"], k=5, cells_per_bucket=3).collect()}
    donors = [(r[0], r[1], np.array(r[2:])) for r in rows if r[1] is not None]
    for r in rows:
        if r[1] is not None:
            assert got[r[0]] == r[1]
            continue
        x = np.array(r[2:])
        d = sorted(((float(((x - v) ** 2).sum()), i, t) for i, t, v in donors))[:5]
        assert abs(got[r[0]] - sum(t for _, _, t in d) / 5) < 1e-9


def test_knn_discrete_features_with_ties(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(300):
        x = [float(rnd.randint(0, 2)), float(rnd.randint(0, 3)), float(rnd.randint(0, 1))]
        t = None if i % 4 == 0 else float(rnd.randint(0, 50))
        rows.append((i, t, *x))
    df = spark.createDataFrame(rows, "id long, t double, a double, b double, c double")
    got = {r["id"]: r["t"] for r in knn_impute(df, df, "id", "t", ["a", "b", "c"], k=5, cells_per_bucket=2).collect()}
    donors = [(r[0], r[1], np.array(r[2:])) for r in rows if r[1] is not None]
    for r in rows:
        if r[1] is None:
            x = np.array(r[2:])
            d = sorted(((float(((x - v) ** 2).sum()), i, t) for i, t, v in donors))[:5]
            assert abs(got[r[0]] - sum(t for _, _, t in d) / 5) < 1e-9


def test_only_the_nearest_of_a_bucket_leave_it(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tabforge.operators import knn
    seen, top_k = [], knn._top_k

    def counted(pairs, k):
        seen.append(pairs.agg(F.max(F.size("near")).alias("most"), F.count("_pid").alias("rows")).first())
        return top_k(pairs, k)

    monkeypatch.setattr(knn, "_top_k", counted)
    df = spark.range(3_000).select("id", F.when(F.col("id") % 5 > 0, F.rand(1) * 9).alias("t"), (F.rand(2) * 1e4).alias("a"), (F.col("id") % 3).alias("b"))
    out = knn.knn_impute(df, df, "id", "t", ["a", "b"], k=5)
    assert out.where("t IS NULL").count() == 0
    assert seen[0]["most"] == 5 and seen[0]["rows"] <= 3 * 600  # 96 cells of a probe before
