"""Linear models of large frames start on a part of the rows and end where they would without."""

import numpy as np
from pyspark.sql import functions as F

from tabforge.operators.models import ModelSpec
from tabforge.training import fits
from tabforge.training.fits import Fit, cross_fits, fit_all, pack_for


def test_models_with_a_start_equal_those_without_in_fewer_passes(spark, monkeypatch):
    df = spark.range(6_000).select("id", F.randn(1).alias("a"), (F.randn(2) * 30 + 5).alias("b"), F.pmod("id", F.lit(3)).alias("fold"), F.rand(3).alias("u"))
    df = df.withColumn("label", (F.col("u") < 1 / (1 + F.exp(-(0.4 + 1.5 * F.col("a") - 0.05 * F.col("b"))))).cast("int")).drop("u")
    specs = [ModelSpec(f"m{c}{r}", "logreg", {"C": c, "l1_ratio": r}) for c in (0.01, 10.0) for r in (0.0, 1.0)]
    packed = pack_for(df, specs, ["a", "b"], ["fold"])
    own = cross_fits(packed, specs, ["a", "b"], [0, 1, 2])
    own += [Fit(ModelSpec("r", "rff", {"n_components": 5}), (0, 1), (("fold", f),)) for f in range(2)]
    plain = fit_all(packed, own).models
    seen, sums = [], fits.block_sums

    def counted(p, n, per_block):
        seen.append(p.n_rows)
        return sums(p, n, per_block)

    monkeypatch.setattr(fits, "block_sums", counted)
    fit_all(packed, own)
    before = seen.count(6_000)
    seen.clear()
    monkeypatch.setattr(fits, "START_ROWS", 700)
    started = fit_all(packed, own).models
    packed.release()
    assert 700 in seen and seen.count(6_000) < before
    for a, b in zip(plain, started, strict=True):
        assert np.allclose(a.weights, b.weights, rtol=1e-3, atol=1e-4)
