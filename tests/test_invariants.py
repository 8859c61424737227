"""Invariants of fold assignment, models, ensembles and the driver contract."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def test_folds_deterministic_and_grouped(spark):
    from tabforge.operators.folds import group_folds, stratified_folds
    from tabforge.plans.fixtures import base
    b = base(spark, SF_SMALL)
    f1 = stratified_folds(b, "id", "label", 5, seed=3).select("id", "fold")
    f2 = stratified_folds(b, "id", "label", 5, seed=3).select("id", F.col("fold").alias("f2"))
    assert f1.join(f2, "id").where("fold <> f2").count() == 0
    assert f1.groupBy("id").count().where("count > 1").count() == 0
    sizes = [r["count"] for r in f1.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 2
    g = group_folds(b, "ticket", 5)
    assert g.groupBy("ticket").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0


def test_models_predict_each_id_once(spark):
    from tabforge.operators.metrics import roc_auc
    from tabforge.operators.models import ModelSpec, oof_predictions
    from tabforge.plans.recipes import MODEL_FEATURES, model_frame
    t = model_frame(spark, SF_SMALL).where("origin = 'train'")
    oof = oof_predictions(t, ModelSpec("rf", "forest", {"n_trees": 10, "max_depth": 4}), MODEL_FEATURES)
    assert oof.count() == t.count()
    assert oof.groupBy("id").count().where("count > 1").count() == 0
    assert oof.where("proba < 0 OR proba > 1").count() == 0
    assert roc_auc(oof, "proba", "label").first()["auc"] > 0.5


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "rate" in df.columns
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 200
