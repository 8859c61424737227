"""Whitening against exact rational arithmetic and numpy's eigenvectors."""

from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tabforge.llm import whitening
from tabforge.llm.queries import op13_embedding_whitening
from tests.llm.conftest import SF


def brute(vectors):
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    z = [[n * r[i] - s[i] for i in range(d)] for r in x]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in z), n ** 3)) for j in range(d)] for i in range(d)])
    return n, v, [sum(c * c for c in r) for r in z], np.array([[float(Fraction(c, n)) for c in r] for r in z])


def compare(got, vectors, ids, components):
    n, v, deviation, centred = brute(vectors)
    values, axes = np.linalg.eigh(v)
    order = np.argsort(-values)[:components]
    want = centred @ axes[:, order] / np.sqrt(values[order])
    table = {(r["vec_id"], r["component"]): r for r in got}
    assert len(table) == len(got) == len(ids) * len(order)
    for k in range(len(order)):
        own = np.array([table[i, k + 1]["whitened"] for i in ids])
        assert min(np.abs(own - want[:, k]).max(), np.abs(own + want[:, k]).max()) < 1e-6
        assert abs(table[ids[0], k + 1]["explained"] / (values[order[k]] / np.trace(v)) - 1) < 1e-9
    assert all(table[i, 1]["deviation"] == dev and table[i, 1]["n"] == n for i, dev in zip(ids, deviation, strict=True))
    assert {r["identity_error"] for r in got}.__len__() == 1 and got[0]["identity_error"] < 1e-9


def test_op13_equals_exact_covariance(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").limit(200).collect()
    frame = spark.createDataFrame(rows).select("vec_id", "embedding")
    compare(whitening.whiten(frame).collect(), [r["embedding"] for r in rows], [r["vec_id"] for r in rows], 32)
    assert op13_embedding_whitening(spark, SF).count() == 32 * spark.read.parquet(f"{SF}/embeddings.parquet").count()


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    kept = rng.normal(size=(40, 5)) * [1, 2, 3, 0.5, 100]
    rows = [(i, v.tolist()) for i, v in enumerate(kept)]
    odd = [(90, None), (91, []), (92, [1.0, None, 2.0, 3.0, 4.0]), (93, [float("nan")] * 5), (94, [float("inf")] * 5), (95, [1.0] * 4)]
    frame = spark.createDataFrame([(*r, 1, 1) for r in rows + odd], "vec_id long, embedding array<double>, n int, v int")
    compare(whitening.whiten(frame).collect(), kept, list(range(40)), 5)
    assert whitening.whiten(frame.limit(0)).count() == 0
    assert whitening.whiten(spark.createDataFrame(odd, "vec_id long, embedding array<double>").where("vec_id < 95")).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, "vec_id long, embedding array<double>")).count() == 0


def test_flat_directions_repeats_and_null_ids(spark):
    # the third dimension is the sum of the others: two components; rows repeat, one id is null
    rows = [(i, [float(i % 7), float(i % 5), float(i % 7 + i % 5)]) for i in range(35)] * 2 + [(None, [1.0, 1.0, 2.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 71 * 2 and {r["component"] for r in got} == {1, 2} and got[0]["identity_error"] < 1e-9
    assert abs(sum(r["explained"] for r in got[:2]) - 1) < 1e-12


def test_huge_entries_stay_exact(spark):
    rows = [(i, [1e300 if i == 0 else 1e12 * i, float(i)]) for i in range(6)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["n"] for r in got} == {6} and max(r["deviation"] for r in got) == 2 ** 63 - 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(-10 ** 9, 10 ** 9), min_size=3, max_size=3), min_size=1, max_size=12))
def test_polarisation_is_exact(values):
    y = np.array(values, dtype=np.int64)
    n, d = y.shape
    totals = [int(t) for t in y.sum(axis=0)]
    centre = [t // n for t in totals]
    squares = dict(enumerate(whitening._squares(y - np.array(centre))))
    got = whitening.covariance(n, totals, centre, {k: int(v) for k, v in squares.items()})
    for i in range(d):
        for j in range(d):
            exact = sum(Fraction(n * int(r[i]) - totals[i], n) * Fraction(n * int(r[j]) - totals[j], n) for r in y) / n
            assert got[i, j] == float(exact)
