"""The registered model queries run at the reference's sizes; stacking is nested."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def test_registered_sizes(spark):
    from tabforge.plans import q_models as Q
    from tabforge.plans.recipes import model_frame
    assert model_frame(spark, SF_SMALL).select("fold").distinct().count() == 5
    assert Q.FOREST.params["n_trees"] == 100 and Q.BOOST.params["n_rounds"] == 100
    assert Q.N_TRIALS == 50 and Q.FOREST_SPACE["n_trees"] == ("int", 50, 200)
    assert [s.params["n_rounds"] for s in Q.REGULARISED] == [100, 100, 100, 50] and {s.kind for s in Q.REGULARISED} == {"xgb"}
    assert {s.params["n_rounds"] for s in Q.LEAFWISE} == {100} and {s.kind for s in Q.LEAFWISE} == {"leafwise"}
    assert {s.kind for s in Q.GRID} == {"forest", "gbt", "leafwise", "logreg"} and len(Q.GRID) == 12
    assert len(Q.FINAL_CONFIGS) > 1


def test_stacking_never_sees_the_held_out_labels(spark):
    from tabforge.operators.models import ModelSpec, stacked_oof
    from tabforge.plans.recipes import MODEL_FEATURES, model_frame
    t = model_frame(spark, SF_SMALL).where("origin = 'train' AND fold < 2")
    bases = [ModelSpec("a", "logreg", {"C": 0.1}), ModelSpec("b", "logreg", {"C": 0.01})]
    metas = [(ModelSpec("plain", "logreg", {"C": 1.0}), []), (ModelSpec("pass", "logreg", {"C": 1.0}), MODEL_FEATURES)]

    def first_fold(x):
        rows = stacked_oof(x, bases, metas, MODEL_FEATURES, inner_folds=2).where("fold = 0").collect()
        return {(r["model"], r["id"]): round(r["proba"], 6) for r in rows}

    got = first_fold(t)
    assert len(got) == 2 * t.where("fold = 0").count()
    flipped = t.withColumn("label", F.when(F.col("fold") == 0, 1 - F.col("label")).otherwise(F.col("label")))
    assert first_fold(flipped) == got


def test_chained_imputation_covers_all_numeric_columns(spark):
    from tabforge.plans import q_models as Q
    rows = Q.q_j19(spark, SF_SMALL)
    assert set(Q.CHAINED) > {"amount_a", "amount_b", "n_sib", "n_par"}
    assert rows.count() == 1500 and rows.where("amount_a IS NULL OR amount_b IS NULL OR region_num IS NULL").count() == 0


def test_blocks_lifts_and_strategies_are_whole(spark, monkeypatch):
    from tabforge.operators.models import ModelSpec
    from tabforge.plans import q_models as Q
    monkeypatch.setattr(Q, "LOGREG", ModelSpec("logreg", "logreg", {"C": 0.1, "max_iter": 5}))
    monkeypatch.setattr(Q, "FOREST", ModelSpec("forest", "forest", {"n_trees": 3, "max_depth": 3}))
    steps = {r["block"]: r for r in Q.q_m12(spark, SF_SMALL).collect()}
    assert {b: r["n_features"] for b, r in steps.items()} == {"baseline": 2} | {b: 2 + len(c) for b, c in Q.BLOCKS.items()}
    assert all(r["max_vif"] >= 1 and 0 <= r["block_importance"] <= 1 for r in steps.values())
    lifts = {r["feature"]: r for r in Q.q_m13(spark, SF_SMALL).collect()}
    assert {"top1", "top2", "top3", "all"} <= set(lifts) and len(lifts) == len(Q.MODEL_FEATURES) - len(Q.BASELINE) + 4
    best = min((r for f, r in lifts.items() if f in Q.MODEL_FEATURES), key=lambda r: r["rank"])
    assert lifts["top1"]["cv_score"] == best["cv_score"]
    recipes = {r["recipe"] for r in Q.q_j17(spark, SF_SMALL).collect()}
    assert recipes == {"global_median", "group_median", "group_mean", "knn", "iterative"}
