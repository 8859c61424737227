"""Models can be shipped in a session whose queries were observed."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tabforge.operators.models import ModelSpec, fit, oof_predictions


def test_models_predict_after_an_observation(spark):
    seen = Observation()
    assert spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).count() == 5 and seen.get["n"] == 5
    df = spark.range(200).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 7 > 2).cast("int").alias("label"),
                                 (F.col("id") % 2).cast("int").alias("fold"))
    for spec in (ModelSpec("lr", "logreg", {"C": 1.0}), ModelSpec("rff", "rff", {"n_components": 3}), ModelSpec("f", "forest", {"n_trees": 2})):
        assert fit(spec, df, ["a"]).predict(df).where("proba BETWEEN 0 AND 1").count() == 200
    assert oof_predictions(df, ModelSpec("lr", "logreg", {"C": 1.0}), ["a"]).where("proba BETWEEN 0 AND 1").count() == 200
