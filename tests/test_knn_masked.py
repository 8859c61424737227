"""Nan-aware nearest neighbours against brute force over all pairs."""

import math
import random

from tabforge.operators.knn_masked import knn_impute_masked


def brute(rows, donors, n, k):
    out = {}
    means = [[d[1 + j] for d in donors if d[1 + j] is not None] for j in range(n)]
    for r in rows:
        filled = list(r[1:])
        for t in range(n):
            if r[1 + t] is not None:
                continue
            near = []
            for d in donors:
                both = [j for j in range(n) if r[1 + j] is not None and d[1 + j] is not None]
                if both and d[1 + t] is not None:
                    near.append((sum((r[1 + j] - d[1 + j]) ** 2 for j in both) * (n / len(both)), d[0], d[1 + t]))
            near = sorted(near)[:k]
            values = [v for _, _, v in near] or means[t]
            filled[t] = sum(values) / len(values) if values else None
        out[r[0]] = filled
    return out


def check(spark, rows, donors, k=5, **options):
    names = ["a", "b", "c", "d"]
    schema = "id long, " + ", ".join(f"{c} double" for c in names) + ", note string"
    df = spark.createDataFrame([(*r, "x") for r in rows], schema)
    given = spark.createDataFrame([(*r, "x") for r in donors], schema)
    out = knn_impute_masked(df, given, "id", names, k, **options)
    assert out.columns == df.columns
    got = {r["id"]: [r[c] for c in names] for r in out.collect()}
    want = brute(rows, donors, 4, k)
    assert got.keys() == want.keys()
    for i, values in want.items():
        for x, y in zip(got[i], values, strict=True):
            assert (x is None) == (y is None) and (x is None or math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9)), (i, got[i], values)


def table(n, seed, holes=0.3, hot=0.0):
    rng = random.Random(seed)
    def row(i):
        v = [1.0, 2.0, 3.0, 4.0] if rng.random() < hot else [rng.gauss(0, 50), float(rng.randrange(5)), rng.gauss(3, 2), float(rng.randrange(40))]
        return (i, *[None if rng.random() < holes else x for x in v])
    return [row(i) for i in range(n)]


def test_equals_brute_force_over_patterns(spark):
    rows = table(400, 1)
    check(spark, rows, rows[:260], cells_per_bucket=4)


def test_one_vector_holds_a_third_of_the_rows(spark):
    rows = table(300, 2, holes=0.15, hot=0.35)
    check(spark, rows, rows, cells_per_bucket=4)


def test_no_shared_coordinate_falls_back_to_the_mean(spark):
    rows = [(1, None, None, None, None), (2, 1.0, None, None, None), (3, None, 2.0, None, None), (4, None, 4.0, None, None)]
    check(spark, rows, rows)  # c and d are known to nobody: they stay null


def test_complete_rows_and_an_empty_fit(spark):
    full = [(1, 1.0, 2.0, 3.0, 4.0), (2, 2.0, 2.0, 3.0, 5.0)]
    check(spark, full, full)
    check(spark, [(3, None, 2.0, 3.0, 5.0), *full], [])
    check(spark, [], full)
