"""Sinks validate and round-trip; model-family invariants (stacking,
isotonic calibration, chained imputation, seeded search)."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def test_prediction_sink_validates(spark):
    from tabforge.sources.files import read_csv, scratch_path, write_predictions
    df = spark.createDataFrame([(1, 0, 0.3), (2, 1, 0.9)], "id long, label int, proba double")
    with pytest.raises(ValueError):
        write_predictions(df, scratch_path(spark, "x"), ["id", "missing"])
    path = scratch_path(spark, "p")
    assert write_predictions(df, path, ["id", "label"], expected_rows=3) == 2
    back = read_csv(spark, path, "id long, label int")
    assert back.columns == ["id", "label"] and back.count() == 2
    with pytest.raises(Exception):
        write_predictions(df, path, ["id", "label"])  # refuses to overwrite


def test_prediction_target_and_an_empty_frame(spark):
    from tabforge.sources.files import prediction_path, scratch_path, write_predictions
    assert prediction_path("s3://x/out/run", ".csv", "20250131_0930") == "s3://x/out/20250131_0930_run.csv"
    assert prediction_path("run.csv", ".csv") == "run.csv"
    path = scratch_path(spark, "q")
    df = spark.range(10).select("id", (F.col("id") % 2).alias("label"))
    assert write_predictions(df, path, ["id", "label"], fmt="parquet", suffix="_v1", stamp="s") == 10
    assert spark.read.parquet(prediction_path(path, "_v1", "s")).count() == 10
    assert write_predictions(df.where("id > 99"), scratch_path(spark, "none"), ["id"], fmt="parquet") == 0
    joined = df.join(df.where("id > 99").select("id"), "id")
    assert write_predictions(joined, scratch_path(spark, "none"), ["id"], fmt="parquet") == 0


def test_json_params_keep_their_types(spark):
    import json
    from tabforge.sources.files import read_model_params, scratch_path
    path = scratch_path(spark, "params")
    given = [{"model": "b", "kind": "forest", "params": {"n_trees": 50, "max_features": "sqrt", "bootstrap": False}},
             {"model": "a", "kind": "logreg", "params": {"C": 0.1}}]
    spark.createDataFrame([(json.dumps(given),)], "j string").coalesce(1).write.text(path)
    assert [(r["model"], r["params"]) for r in read_model_params(spark, path)] == [("a", given[1]["params"]), ("b", given[0]["params"])]
    bad = scratch_path(spark, "bad")
    spark.createDataFrame([('[{"model": "a"}]',)], "j string").coalesce(1).write.text(bad)
    with pytest.raises(ValueError):
        read_model_params(spark, bad)


def test_csv_quotes_round_trip(spark):
    from tabforge.sources.files import read_csv, scratch_path, write_table
    rows = [(1, 'Smith, Mr. "Jack"'), (2, "plain")]
    df = spark.createDataFrame(rows, "id long, name string")
    path = scratch_path(spark, "q")
    write_table(df, path, fmt="csv")
    assert sorted(tuple(r) for r in read_csv(spark, path, "id long, name string").collect()) == rows


def test_stacking_and_isotonic_invariants(spark):
    from tabforge.operators.models import ModelSpec, isotonic_calibrated_oof, oof_predictions, stack_frame
    from tabforge.plans.recipes import MODEL_FEATURES, model_frame
    t = model_frame(spark, SF_SMALL).where("origin = 'train'")
    n = t.count()
    a = oof_predictions(t, ModelSpec("lr", "logreg", {"C": 0.1}), MODEL_FEATURES)
    b = oof_predictions(t, ModelSpec("rf", "forest", {"n_trees": 5, "max_depth": 3}), MODEL_FEATURES)
    st = stack_frame(a.unionByName(b), models=["lr", "rf"])
    assert st.count() == n and st.where("lr IS NULL OR rf IS NULL").count() == 0
    cal = isotonic_calibrated_oof(t, ModelSpec("rf", "forest", {"n_trees": 5, "max_depth": 3}), MODEL_FEATURES)
    assert cal.count() == n and cal.where("proba < 0 OR proba > 1").count() == 0


def test_chained_linear_imputer_fills(spark):
    from tabforge.operators.impute import ChainedLinearImputer
    from tabforge.plans.fixtures import base
    b = base(spark, SF_SMALL).select("id", "amount_a", "amount_b", "n_sib", "n_par")
    out = ChainedLinearImputer(["amount_a", "amount_b"], ["n_sib", "n_par"], max_rounds=2).fit(b).transform(b)
    assert out.where("amount_a IS NULL OR amount_b IS NULL").count() == 0
    kept = out.join(b.select("id", F.col("amount_a").alias("orig")), "id").where("orig IS NOT NULL")
    assert kept.where("orig <> amount_a").count() == 0


def test_random_search_is_seeded():
    from tabforge.operators.models import random_configs
    space = {"n": ("int", 1, 9), "lr": ("log", 0.01, 0.3), "m": ("cat", ["a", "b"])}
    a = random_configs("x", "gbt", space, 5, seed=1)
    b = random_configs("x", "gbt", space, 5, seed=1)
    assert [s.params for s in a] == [s.params for s in b]
    assert all(1 <= s.params["n"] <= 9 and 0.01 <= s.params["lr"] <= 0.3 for s in a)
