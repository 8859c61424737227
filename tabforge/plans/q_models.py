"""Model training, validation sweeps, stacking and calibration (L*, M6-M24,
P10-P12, J17, J19) at the reference's sizes: 5 folds, 100 trees or boosting
rounds, 50 trials of a search. All go through joint training. Trained models have no SQL; their splits, gains, margins and fits are tested
against brute force. L8 and the isotonic values are plain SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabforge.operators.chained import fit_chained
from tabforge.operators.folds import group_folds
from tabforge.operators.isotonic import isotonic_values
from tabforge.operators.metrics import brier, log_loss
from tabforge.operators.models import (ModelSpec, cv_summary, evaluate, fit, fold_scores,
                                       oof_predictions, stack_frame, train_score)
from tabforge.operators.profile import correlations, eliminate_collinear, vif
from tabforge.plans.fixtures import base, scores
from tabforge.plans.recipes import MODEL_FEATURES, model_frame
from tabforge.plans.registry import query
from tabforge.session import cut_lineage
from tabforge.training.blocks import pack, packed_once
from tabforge.training.fits import Fit, calibrated_table, cv_table, fit_all, stacked_table, strategy_table
from tabforge.training.search import search

LOGREG = ModelSpec("logreg", "logreg", {"C": 0.1, "max_iter": 1000})
FOREST = ModelSpec("forest", "forest", {"n_trees": 100, "max_depth": 5, "min_samples_split": 4})
BOOST = ModelSpec("gbt", "gbt", {"n_rounds": 100, "max_depth": 3, "learning_rate": 0.1})


def _train(spark, sf):
    return model_frame(spark, sf).where(F.col("origin") == "train")


def _round(df, cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


def _cv(spark, sf, spec, feats=None):
    t = _train(spark, sf)
    feats = feats or MODEL_FEATURES
    with packed_once(t, feats, ["fold"]):
        oof = oof_predictions(t, spec, feats)
        scored = train_score(spec, t, feats)
    return _round(cv_summary(oof, scored), ["cv_score", "cv_std", "oof_score", "train_score", "gap"])


@query("q_l1_logistic_l2")
def q_l1(spark, sf):
    oof = oof_predictions(_train(spark, sf), LOGREG, MODEL_FEATURES)
    return _round(fold_scores(oof), ["score"])


@query("q_l2_logistic_elastic_net")
def q_l2(spark, sf):
    return _cv(spark, sf, ModelSpec("enet", "logreg", {"C": 0.1, "l1_ratio": 0.5, "max_iter": 2000}))


@query("q_l3_random_forest")
def q_l3(spark, sf):
    return _table(spark, sf, [FOREST], {"all": MODEL_FEATURES}).drop("feature_set", "n_features")


@query("q_l4_gradient_boosting")
def q_l4(spark, sf):
    return _cv(spark, sf, BOOST)


# The leaf-wise configurations (three of strong regularisation, and a larger tree).
LEAFWISE = [ModelSpec(name, "leafwise", {"n_rounds": 100, "max_depth": depth, "num_leaves": leaves, "min_leaf": least, "l1": reg, "l2": reg,
                                         "min_gain": gain, "learning_rate": 0.05, "colsample": col})
            for name, depth, leaves, least, reg, gain, col in [
                ("leafwise_strong", 2, 4, 40, 2.0, 0.02, 0.7), ("leafwise_stronger", 2, 4, 50, 3.0, 0.03, 0.6),
                ("leafwise_few_leaves", 2, 3, 35, 1.5, 0.015, 0.75), ("leafwise", 4, 10, 20, 0.5, 0.01, 0.8)]]


@query("q_l5_leafwise_boosting_config")
def q_l5(spark, sf):
    return _table(spark, sf, LEAFWISE, {"all": MODEL_FEATURES}).drop("feature_set", "n_features")


# The four regularisation levels of second-order boosting.
REGULARISED = [ModelSpec(f"xgb_{name}", "xgb", {"n_rounds": n, "max_depth": depth, "learning_rate": rate, "subsample": part, "colsample": part,
                                                "min_child_weight": weight, "l1": reg, "l2": reg, "min_gain": gain})
               for name, n, depth, rate, part, weight, reg, gain in [
                   ("light", 100, 3, 0.05, 0.8, 10, 0.5, 0.1), ("medium", 100, 2, 0.05, 0.8, 20, 1.0, 0.2),
                   ("strong", 100, 2, 0.03, 0.7, 30, 1.5, 0.3), ("very_strong", 50, 2, 0.03, 0.7, 40, 2.0, 0.5)]]


@query("q_l6_regularised_boosting_configs")
def q_l6(spark, sf):
    return _table(spark, sf, REGULARISED, {"all": MODEL_FEATURES}).drop("feature_set", "n_features")


@query("q_l7_rbf_kernel_fourier_features")
def q_l7(spark, sf):
    return _cv(spark, sf, ModelSpec("rff_svm", "rff", {"C": 1.0, "n_components": 40}))


@query("q_l7_rbf_kernel_svm")
def q_l7_svm(spark, sf):
    return _table(spark, sf, [ModelSpec("svm", "svm", {"C": 1.0, "n_landmarks": 64})], {"all": MODEL_FEATURES}).drop("feature_set", "n_features")


@query("q_l8_linear_regression_r2", """
SELECT round(regr_r2(amount_b, amount_a), 6) AS r2, count(*) FILTER (WHERE amount_a IS NOT NULL AND amount_b IS NOT NULL) AS n FROM base""")
def q_l8(spark, sf):
    b = base(spark, sf)
    return b.agg(F.round(F.regr_r2(F.col("amount_b"), F.col("amount_a")), 6).alias("r2"),
                 F.count(F.when(F.col("amount_a").isNotNull() & F.col("amount_b").isNotNull(), 1)).alias("n"))


@query("q_l9_feature_importance")
def q_l9(spark, sf):
    m = fit(FOREST, _train(spark, sf), MODEL_FEATURES)
    return m.importances(spark)


@query("q_l10_predict_frame")
def q_l10(spark, sf):
    f = model_frame(spark, sf)
    m = fit(LOGREG, f.where(F.col("origin") == "train"), MODEL_FEATURES)
    return m.predict(f.where(F.col("origin") == "serve")).select("id", F.round("proba", 6).alias("proba"), "pred")


@query("q_l11_train_accuracy")
def q_l11(spark, sf):
    return _round(train_score(FOREST, _train(spark, sf), MODEL_FEATURES), ["train_score"])


# Simple-baseline feature sets (3, 5 and all features).
FEATURE_SETS = {"fs3": ["amount_b", "family_size", "title_code"],
                "fs5": ["amount_b", "family_size", "title_code", "amount_a", "is_alone"],
                "all": MODEL_FEATURES}


def _table(spark, sf, specs, sets):
    """All configurations on all feature sets, fitted together."""
    return _round(cv_table(_train(spark, sf), specs, sets), ["cv_score", "cv_std", "oof_score", "train_score", "gap"])


@query("q_l12_baseline_model_family")
def q_l12(spark, sf):
    return _table(spark, sf, [LOGREG, FOREST, BOOST], FEATURE_SETS)


@query("q_m6_cross_validated_score")
def q_m6(spark, sf):
    oof = oof_predictions(_train(spark, sf), BOOST, MODEL_FEATURES)
    fs = fold_scores(oof)
    s = fs.groupBy("model").agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"))
    return _round(fs.join(s, "model"), ["score", "mean", "std"])


@query("q_m7_oof_prediction_table")
def q_m7(spark, sf):
    return _round(oof_predictions(_train(spark, sf), LOGREG, MODEL_FEATURES), ["proba"])


@query("q_m11_feature_set_model_sweep")
def q_m11(spark, sf):
    return _table(spark, sf, [LOGREG, BOOST], FEATURE_SETS)


# Baseline and feature blocks of the incremental evaluation.
BASELINE = ["amount_b", "title_code"]
BLOCKS = {"family": ["family_size", "is_alone"], "category": ["cat_O", "cat_P"], "amount_a": ["amount_a"],
          "unit": ["has_unit"]}


@query("q_m12_incremental_feature_evaluation")
def q_m12(spark, sf):
    t = _train(spark, sf)
    out = None
    for step, (name, cols) in enumerate([("baseline", [])] + list(BLOCKS.items())):
        cur = BASELINE + cols  # the baseline with one block at a time
        with packed_once(t, cur, ["fold"]):
            r = evaluate([LOGREG], t, cur, with_train=False)
            imp = fit(FOREST, t, cur).importances(spark).where(F.col("feature").isin(cols or cur))
        worst = vif(t, cur).agg(F.max("vif").alias("max_vif"))
        mc = correlations(t, cur).agg(F.max(F.abs("corr")).alias("max_abs_corr"))
        imp = imp.agg(F.sum("importance").alias("block_importance"))
        r = r.withColumn("step", F.lit(step)).withColumn("block", F.lit(name)).withColumn("n_features", F.lit(len(cur)))
        r = r.crossJoin(mc).crossJoin(worst).crossJoin(imp)
        out = r if out is None else out.unionByName(r)
    return _round(out, ["cv_score", "cv_std", "oof_score", "max_abs_corr", "max_vif", "block_importance"])


@query("q_m13_single_feature_lift")
def q_m13(spark, sf):
    t = _train(spark, sf)
    base_r = evaluate([LOGREG], t, BASELINE, with_train=False).select(F.col("cv_score").alias("base_cv"))
    out = None
    for c in [x for x in MODEL_FEATURES if x not in BASELINE]:
        r = evaluate([LOGREG], t, BASELINE + [c], with_train=False).select(F.lit(c).alias("feature"), "cv_score")
        out = r if out is None else out.unionByName(r)
    top = [r["feature"] for r in out.orderBy(F.col("cv_score").desc(), "feature").limit(3).collect()]
    # the best features together: top 1, 2, 3 and all
    for name, cols in [("top1", top[:1]), ("top2", top[:2]), ("top3", top[:3]), ("all", [x for x in MODEL_FEATURES if x not in BASELINE])]:
        r = evaluate([LOGREG], t, BASELINE + cols, with_train=False).select(F.lit(name).alias("feature"), "cv_score")
        out = out.unionByName(r)
    lift = out.crossJoin(base_r).withColumn("lift", F.col("cv_score") - F.col("base_cv"))
    lift = lift.withColumn("rank", F.row_number().over(Window.partitionBy(F.col("feature").isin("top1", "top2", "top3", "all"))
                                                      .orderBy(F.col("lift").desc(), "feature")))
    return _round(lift, ["cv_score", "base_cv", "lift"])


# The regularisation grid over four model families.
GRID = [
    ModelSpec("forest_d3", "forest", {"n_trees": 100, "max_depth": 3, "min_samples_split": 30, "min_samples_leaf": 15}),
    ModelSpec("forest_d2", "forest", {"n_trees": 100, "max_depth": 2, "min_samples_split": 40, "min_samples_leaf": 20}),
    ModelSpec("forest_50", "forest", {"n_trees": 50, "max_depth": 3, "min_samples_split": 25, "min_samples_leaf": 12}),
    ModelSpec("gbt_strong", "gbt", {"n_rounds": 100, "max_depth": 2, "learning_rate": 0.03, "min_samples_split": 30, "min_leaf": 15, "subsample": 0.7,
                                    "max_features": "sqrt"}),
    ModelSpec("gbt_slow", "gbt", {"n_rounds": 150, "max_depth": 2, "learning_rate": 0.02, "min_samples_split": 35, "min_leaf": 20, "subsample": 0.6,
                                  "max_features": 0.7}),
    ModelSpec("gbt_d1", "gbt", {"n_rounds": 100, "max_depth": 1, "learning_rate": 0.05, "min_samples_split": 20, "min_leaf": 10, "subsample": 0.8}),
    *LEAFWISE[:3],
    ModelSpec("logreg_C0.1", "logreg", {"C": 0.1, "max_iter": 1000}), ModelSpec("logreg_C0.05", "logreg", {"C": 0.05, "max_iter": 1000}),
    ModelSpec("enet_C0.1", "logreg", {"C": 0.1, "l1_ratio": 0.5, "max_iter": 2000})]


@query("q_m14_regularisation_grid")
def q_m14(spark, sf):
    return _table(spark, sf, GRID, {"all": MODEL_FEATURES}).drop("feature_set", "n_features")


# C path of the linear model.
C_PATH = [0.001, 0.01, 0.05, 0.1, 0.5, 1.0, 10.0]


@query("q_m15_c_value_path")
def q_m15(spark, sf):
    specs = [ModelSpec(f"logreg_C{c}", "logreg", {"C": c, "max_iter": 1000}) for c in C_PATH]
    r = evaluate(specs, _train(spark, sf), MODEL_FEATURES)
    return _round(r, ["cv_score", "cv_std", "oof_score", "train_score", "gap"])


# Search space of the forest search.
FOREST_SPACE = {"n_trees": ("int", 50, 200), "max_depth": ("int", 3, 10), "min_samples_split": ("int", 2, 20),
                "min_samples_leaf": ("int", 1, 10), "max_features": ("cat", ["sqrt", "log2", "all"]),
                "bootstrap": ("cat", [True, False])}
N_TRIALS = 50


@query("q_m16_random_search")
def q_m16(spark, sf):
    r = search(_train(spark, sf), "forest", FOREST_SPACE, MODEL_FEATURES, n_trials=N_TRIALS)
    return _round(r, ["cv_score", "cv_std", "oof_score"])


# Search space of the linear model.
LINEAR_SPACE = {"C": ("log", 0.001, 100.0), "l1_ratio": ("cat", [0.0, 1.0])}


@query("q_m16_linear_search")
def q_m16_linear(spark, sf):
    r = search(_train(spark, sf), "logreg", LINEAR_SPACE, MODEL_FEATURES, n_trials=N_TRIALS)
    return _round(r, ["cv_score", "cv_std", "oof_score"])


@query("q_m22_cv_strategy_comparison")
def q_m22(spark, sf):
    t = group_folds(_train(spark, sf).withColumnRenamed("fold", "strat_fold"), "ticket", 5, label="label").withColumnRenamed("fold", "group_fold")
    r = strategy_table(t, [LOGREG, FOREST, BOOST], MODEL_FEATURES, {"stratified": "strat_fold", "group": "group_fold"})
    w = Window.partitionBy("model")
    diff = F.max(F.when(F.col("strategy") == "group", F.col("cv_score"))).over(w) - \
        F.max(F.when(F.col("strategy") == "stratified", F.col("cv_score"))).over(w)
    return _round(r.withColumn("strategy_diff", diff), ["cv_score", "cv_std", "oof_score", "train_score", "gap", "gap_pct", "strategy_diff"])


# Configurations of the final fit; the best by out-of-fold accuracy is fitted on all train rows.
FINAL_CONFIGS = [ModelSpec(f"forest_d{d}", "forest", {"n_trees": 100, "max_depth": d, "min_samples_split": split,
                                                      "min_samples_leaf": leaf})
                 for d, split, leaf in [(4, 15, 5), (5, 10, 4), (6, 10, 4)]] + [BOOST]


@query("q_m24_final_fit_and_write")
def q_m24(spark, sf):
    from tabforge.sources.files import scratch_path, write_predictions
    f = model_frame(spark, sf)
    t = f.where(F.col("origin") == "train")
    with packed_once(t, MODEL_FEATURES, ["fold"]):
        table = evaluate(FINAL_CONFIGS, t, MODEL_FEATURES, with_train=False)
        best = table.orderBy(F.col("oof_score").desc(), "model").first()["model"]
        m = fit(next(s for s in FINAL_CONFIGS if s.name == best), t, MODEL_FEATURES)
    serve = f.where(F.col("origin") == "serve")
    pred = cut_lineage(m.predict(serve).select("id", F.col("pred").alias("label")))  # predicted once
    path = scratch_path(spark, "final_predictions")
    write_predictions(pred, path, ["id", "label"], expected_rows=base(spark, sf).where("origin = 'serve'").count(), fmt="parquet")
    return spark.read.parquet(path)


@query("q_p10_stacking_from_oof")
def q_p10(spark, sf):
    t = _train(spark, sf)
    oof = None
    with packed_once(t, MODEL_FEATURES, ["fold"]):
        for s in (LOGREG, FOREST, BOOST):
            o = oof_predictions(t, s, MODEL_FEATURES)
            oof = o if oof is None else oof.unionByName(o)
    st = stack_frame(oof, models=["logreg", "forest", "gbt"]).join(t.select("id", "fold"), "id")
    meta = oof_predictions(st, ModelSpec("stack", "logreg", {"C": 0.1}), ["logreg", "forest", "gbt"])
    return _round(cv_summary(oof.unionByName(meta)), ["cv_score", "cv_std", "oof_score"])


@query("q_p11_stacking_passthrough")
def q_p11(spark, sf):
    metas = [(ModelSpec(f"stack_C{c}_{'pass' if extra else 'plain'}", "logreg", {"C": c, "max_iter": 1000}), extra)
             for c in (0.1, 0.5, 1.0) for extra in ([], MODEL_FEATURES)]
    oof = stacked_table(_train(spark, sf), [LOGREG, FOREST, BOOST], metas, MODEL_FEATURES)
    return _round(cv_summary(oof), ["cv_score", "cv_std", "oof_score"])


@query("q_p12_isotonic_calibration")
def q_p12(spark, sf):
    both = calibrated_table(_train(spark, sf), [LOGREG, FOREST, BOOST], MODEL_FEATURES)
    g = both.groupBy("model", "cv").agg(F.avg((F.col("pred") == F.col("label")).cast("double")).alias("accuracy"),
                                        brier(F.col("proba"), F.col("label")).alias("brier"),
                                        log_loss(F.col("proba"), F.col("label")).alias("log_loss"))
    return _round(g, ["accuracy", "brier", "log_loss"])


@query("q_p12_isotonic_values", """
WITH p AS (SELECT model, floor(proba * 100 + 0.000001) / 100 AS x, count(*) AS w, sum(label) AS s FROM scores GROUP BY ALL),
c AS (SELECT model, x, w, sum(w) OVER k AS cw, sum(s) OVER k AS cs, sum(w) OVER k - w AS bw, sum(s) OVER k - s AS bs FROM p
      WINDOW k AS (PARTITION BY model ORDER BY x)),
m AS (SELECT i.model, i.x, i.w, a.x AS lo, min((b.cs - a.bs) / CAST(b.cw - a.bw AS DOUBLE)) AS least
      FROM c i JOIN c a ON a.model = i.model AND a.x <= i.x JOIN c b ON b.model = i.model AND b.x >= i.x GROUP BY ALL)
SELECT model, x AS score, CAST(w AS BIGINT) AS w, round(max(least), 6) AS value FROM m GROUP BY model, x, w""")
def q_p12_values(spark, sf):
    v = isotonic_values(scores(spark, sf).withColumn("x", F.floor(F.col("proba") * 100 + 0.000001) / F.lit(100.0)), "model", "x", "label")
    return v.select(F.col("key").alias("model"), "score", "w", F.round("value", 6).alias("value"))


@query("q_j17_imputation_strategy_comparison")
def q_j17(spark, sf):
    from tabforge.operators.impute import GroupImputer
    from tabforge.operators.knn import knn_impute
    t = _train(spark, sf)
    b = base(spark, sf).where(F.col("origin") == "train").select("id", F.col("amount_a").alias("raw_a"), F.col("amount_b").alias("raw_b"),
                                                                     "klass", "category", "n_sib", "n_par")
    x = t.join(b, "id").withColumn("klass_num", F.substring("klass", 1, 1).cast("int"))
    knn = knn_impute(x, x, "id", "raw_a", ["klass_num", "n_sib", "n_par", "amount_b"], k=5, out="a_imp")
    chained = fit_chained(x, ["raw_a", "raw_b", "klass_num", "n_sib", "n_par"]).transform(x)
    recipes = {"global_median": GroupImputer("raw_a", [], out="a_imp"),
               "group_median": GroupImputer("raw_a", [["klass", "category"]], out="a_imp"),
               "group_mean": GroupImputer("raw_a", [["klass"]], stat="mean", out="a_imp")}
    out = None
    feats = [c for c in MODEL_FEATURES if c != "amount_a"] + ["a_imp"]
    filled = {k: imp.fit(x).transform(x) for k, imp in recipes.items()}
    filled |= {"knn": knn, "iterative": chained.withColumn("a_imp", F.col("raw_a"))}
    for name, xi in filled.items():
        xi = cut_lineage(xi)
        r = evaluate([LOGREG, FOREST], xi, feats, with_train=False).withColumn("recipe", F.lit(name))
        out = r if out is None else out.unionByName(r)
    return _round(out, ["cv_score", "cv_std", "oof_score"])


# all numeric columns take part; the class codes are numbers too
CHAINED = ["amount_a", "amount_b", "n_sib", "n_par", "klass_num", "region_num"]


@query("q_j19_iterative_imputation")
def q_j19(spark, sf):
    b = base(spark, sf).select("id", "amount_a", "amount_b", "n_sib", "n_par", F.substring("klass", 1, 1).cast("int").alias("klass_num"),
                               F.ascii("region").alias("region_num"))
    filled = fit_chained(b, CHAINED).transform(b)
    return _round(filled.select("id", "amount_a", "amount_b", "region_num"), ["amount_a", "amount_b", "region_num"])


# The models that score feature subsets.
SUBSET_MODELS = [ModelSpec("forest", "forest", {"n_trees": 100, "max_depth": 5, "min_samples_leaf": 5}), BOOST,
                 ModelSpec("logreg", "logreg", {"C": 1.0, "max_iter": 1000})]


@query("q_k14_scored_subsets")
def q_k14_subsets(spark, sf):
    """Subsets of the features: all, those of low VIF, the five most important, and without one of two related ones;
    every one scored by three models, all fitted together."""
    t = _train(spark, sf)
    low = {r["feature"] for r in eliminate_collinear(t, MODEL_FEATURES).where("action = 'keep'").collect()}  # a row a feature
    with packed_once(t, MODEL_FEATURES, ["fold"]):
        packed = pack(t, MODEL_FEATURES, ["fold"])
        gains = fit_all(packed, [Fit(SUBSET_MODELS[0], tuple(range(len(MODEL_FEATURES))))]).gains[0]
        packed.release()
        top = sorted(range(len(gains)), key=lambda j: (-gains[j], j))[:5]
        sets = {"current": MODEL_FEATURES, "low_vif": [c for c in MODEL_FEATURES if c in low], "top_5": [MODEL_FEATURES[j] for j in sorted(top)],
                "no_is_alone": [c for c in MODEL_FEATURES if c != "is_alone"], "no_family_size": [c for c in MODEL_FEATURES if c != "family_size"]}
        r = cv_table(t, SUBSET_MODELS, sets, with_train=False)
    wide = r.groupBy("feature_set", "n_features").agg(
        *[F.max(F.when(F.col("model") == s.name, F.col(c))).alias(f"{s.name}_{n}") for s in SUBSET_MODELS for c, n in (("cv_score", "mean"), ("cv_std", "std"))],
        F.avg("cv_score").alias("avg_mean"))
    return _round(wide, [c for c in wide.columns if c.endswith(("_mean", "_std"))])
