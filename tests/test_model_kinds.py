"""Every model family trains on Spark ML and beats chance on the learnable
label of the model frame; importances form a distribution."""

import pytest

from tests.conftest import SF_SMALL

KINDS = [("logreg", {"C": 0.1}), ("logreg", {"C": 0.1, "l1_ratio": 0.5}), ("forest", {"n_trees": 8, "max_depth": 4}),
         ("gbt", {"n_rounds": 5, "max_depth": 2}), ("rff", {"C": 1.0, "n_components": 16})]


@pytest.mark.parametrize("kind,params", KINDS)
def test_model_kind_cv(spark, kind, params):
    from tabforge.operators.models import ModelSpec, evaluate
    from tabforge.plans.recipes import MODEL_FEATURES, model_frame
    t = model_frame(spark, SF_SMALL).where("origin = 'train'")
    r = evaluate([ModelSpec("m", kind, params)], t, MODEL_FEATURES).first()
    assert 0.5 < r["oof_score"] <= 1.0 and 0.0 <= r["cv_std"] < 0.5
    assert r["train_score"] >= r["cv_score"] - 0.2


def test_importances_distribution(spark):
    from tabforge.operators.models import ModelSpec, fit
    from tabforge.plans.recipes import MODEL_FEATURES, model_frame
    t = model_frame(spark, SF_SMALL).where("origin = 'train'")
    imp = fit(ModelSpec("rf", "forest", {"n_trees": 8, "max_depth": 4}), t, MODEL_FEATURES).importances(spark).collect()
    assert abs(sum(r["importance"] for r in imp) - 1.0) < 1e-6
    assert [r["rank"] for r in imp] == list(range(1, len(MODEL_FEATURES) + 1))
