"""Ensembles, calibration comparison and diversity (P*) on long predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.operators.ensemble import (accuracy, fixed_weights, hard_vote, label_mean_vote,
                                         normalised_weights, pair_diversity, prediction_spread,
                                         seed_average, soft_vote, with_pred)
from tabforge.operators.metrics import bin_calibrate, brier, log_loss
from tabforge.plans.fixtures import scores, seeded_scores
from tabforge.plans.registry import query

S = "WITH s AS (SELECT *, CASE WHEN proba >= 0.5 THEN 1 ELSE 0 END AS pred FROM scores)"
ACC = "acc AS (SELECT model, avg(CAST(pred = label AS DOUBLE)) AS acc FROM s GROUP BY model)"


def _s(spark, sf):
    return with_pred(scores(spark, sf))


def _acc(s):
    return s.groupBy("model").agg(accuracy(F.col("pred"), F.col("label")).alias("acc"))


@query("q_p1_label_mean_vote_half_even", S + """
SELECT id, CAST(round_even(avg(CAST(pred AS DOUBLE)), 0) AS INTEGER) AS vote FROM s WHERE model IN ('m1', 'm2') GROUP BY id""")
def q_p1(spark, sf):
    return label_mean_vote(_s(spark, sf).where(F.col("model").isin("m1", "m2")))


@query("q_p1_label_mean_vote_all_models", """
WITH m4 AS (SELECT id, 'm4' AS model, least(CAST(1 AS DOUBLE), greatest(CAST(0 AS DOUBLE),
             proba + CAST((id * 59 + 11) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) - CAST(0.5 AS DOUBLE))) AS proba
            FROM scores WHERE model = 'm3'),
s AS (SELECT id, CASE WHEN proba >= 0.5 THEN 1 ELSE 0 END AS pred FROM (SELECT id, proba FROM scores UNION ALL SELECT id, proba FROM m4))
SELECT id, CAST(round_even(avg(CAST(pred AS DOUBLE)), 0) AS INTEGER) AS vote FROM s GROUP BY id""")
def q_p1_all(spark, sf):
    """All three models and a fourth, the third with noise, so that votes tie."""
    s = scores(spark, sf)
    noise = ((F.col("id") * 59 + 11) % 1000).cast("double") / F.lit(1000.0)
    m4 = s.where(F.col("model") == "m3").withColumn("model", F.lit("m4")).withColumn(
        "proba", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("proba") + noise - F.lit(0.5))))
    return label_mean_vote(with_pred(s.unionByName(m4)))


@query("q_p2_hard_vote", S + """
SELECT id, CAST(avg(CAST(pred AS DOUBLE)) > 0.5 AS INTEGER) AS vote FROM s GROUP BY id""")
def q_p2(spark, sf):
    return hard_vote(_s(spark, sf))


@query("q_p3_soft_vote", """
SELECT id, round(avg(proba), 6) AS proba, CAST(avg(proba) >= 0.5 AS INTEGER) AS vote FROM scores GROUP BY id""")
def q_p3(spark, sf):
    v = soft_vote(scores(spark, sf))
    return v.select("id", F.round("proba", 6).alias("proba"), "vote")


@query("q_p4_score_weighted_vote", S + ", " + ACC + """,
w AS (SELECT model, acc / (SELECT sum(acc) FROM acc) AS weight FROM acc)
SELECT id, round(sum(weight * proba) / sum(weight), 6) AS proba, CAST(sum(weight * proba) / sum(weight) >= 0.5 AS INTEGER) AS vote
FROM s JOIN w USING (model) GROUP BY id""")
def q_p4(spark, sf):
    s = _s(spark, sf).persist()
    w = normalised_weights(_acc(s), "model", "acc")
    v = soft_vote(s, weights=w)
    return v.select("id", F.round("proba", 6).alias("proba"), "vote")


# Literal weights of the two-model soft vote.
FIXED_WEIGHTS = {"m1": 2.0, "m2": 1.0}


@query("q_p5_fixed_weight_vote", """
WITH w AS (SELECT * FROM (VALUES ('m1', CAST(2.0 AS DOUBLE)), ('m2', CAST(1.0 AS DOUBLE))) t(model, weight))
SELECT id, round(sum(weight * proba) / sum(weight), 6) AS proba, CAST(sum(weight * proba) / sum(weight) >= 0.5 AS INTEGER) AS vote
FROM scores JOIN w USING (model) GROUP BY id""")
def q_p5(spark, sf):
    v = soft_vote(scores(spark, sf), weights=fixed_weights(spark, FIXED_WEIGHTS), only_weighted=True)
    return v.select("id", F.round("proba", 6).alias("proba"), "vote")


@query("q_p6_top_k_ensemble", S + ", " + ACC + """,
top AS (SELECT * FROM acc ORDER BY acc DESC, model LIMIT 2),
w AS (SELECT model, acc / (SELECT sum(acc) FROM top) AS weight FROM top)
SELECT id, round(sum(weight * proba) / sum(weight), 6) AS proba FROM s JOIN w USING (model) GROUP BY id""")
def q_p6(spark, sf):
    s = _s(spark, sf).persist()
    w = normalised_weights(_acc(s), "model", "acc", top_k=2)
    return soft_vote(s, weights=w, only_weighted=True).select("id", F.round("proba", 6).alias("proba"))


@query("q_p7_seed_averaging", """
WITH pm AS (SELECT model, id, avg(proba) AS p FROM seeded GROUP BY model, id)
SELECT id, round(avg(p), 6) AS proba FROM pm GROUP BY id""")
def q_p7(spark, sf):
    return seed_average(seeded_scores(spark, sf)).select("id", F.round("proba", 6).alias("proba"))


@query("q_p8_prediction_spread", """
WITH sd AS (SELECT model, id, stddev_pop(proba) AS s FROM seeded GROUP BY model, id)
SELECT model, round(avg(s), 6) AS mean_std, round(max(s), 6) AS max_std FROM sd GROUP BY model""")
def q_p8(spark, sf):
    sp = prediction_spread(seeded_scores(spark, sf), "seed", keys="model")
    return sp.select("model", F.round("mean_std", 6).alias("mean_std"), F.round("max_std", 6).alias("max_std"))


@query("q_p9_ensemble_catalogue", S + ", " + ACC + """,
w AS (SELECT model, acc / (SELECT sum(acc) FROM acc) AS weight FROM acc),
top AS (SELECT * FROM acc ORDER BY acc DESC, model LIMIT 2),
tw AS (SELECT model, acc / (SELECT sum(acc) FROM top) AS weight FROM top),
cat AS (SELECT 'single' AS method, id, label, proba FROM s WHERE model = 'm1'
  UNION ALL SELECT 'equal', id, any_value(label), avg(proba) FROM s GROUP BY id
  UNION ALL SELECT 'weighted', id, any_value(label), sum(weight * proba) / sum(weight) FROM s JOIN w USING (model) GROUP BY id
  UNION ALL SELECT 'top2', id, any_value(label), sum(weight * proba) / sum(weight) FROM s JOIN tw USING (model) GROUP BY id)
SELECT method, round(avg(CAST(CAST(proba >= 0.5 AS INTEGER) = label AS DOUBLE)), 6) AS accuracy,
       round(avg(CAST(proba >= 0.5 AS DOUBLE)), 6) AS positive_rate FROM cat GROUP BY method""")
def q_p9(spark, sf):
    s = _s(spark, sf).persist()
    acc = _acc(s).persist()
    labels = s.where(F.col("model") == "m1").select("id", "label")
    parts = {
        "single": s.where(F.col("model") == "m1").select("id", "proba"),
        "equal": soft_vote(s).select("id", "proba"),
        "weighted": soft_vote(s, weights=normalised_weights(acc, "model", "acc")).select("id", "proba"),
        "top2": soft_vote(s, weights=normalised_weights(acc, "model", "acc", top_k=2), only_weighted=True).select("id", "proba"),
    }
    cat = None
    for name, df in parts.items():
        df = df.withColumn("method", F.lit(name))
        cat = df if cat is None else cat.unionByName(df)
    cat = cat.join(labels, "id")
    hit = (F.col("proba") >= 0.5).cast("int")
    return cat.groupBy("method").agg(F.round(accuracy(hit, F.col("label")), 6).alias("accuracy"),
                                     F.round(F.avg(hit.cast("double")), 6).alias("positive_rate"))


def _ll(p):
    q = f"least(greatest({p}, 1e-15), 1 - 1e-15)"
    return f"avg(-(CAST(label AS DOUBLE) * ln({q}) + (1 - CAST(label AS DOUBLE)) * ln(1 - {q})))"


@query("q_p13_calibration_comparison", f"""
WITH b AS (SELECT *, CAST(least(floor(proba * 10), 9) AS INTEGER) AS bin FROM scores),
rt AS (SELECT model, bin, avg(CAST(label AS DOUBLE)) AS calibrated FROM b GROUP BY model, bin),
x AS (SELECT b.*, rt.calibrated FROM b JOIN rt USING (model, bin)),
l AS (SELECT model, 0 AS calibrated, label, proba AS p FROM x UNION ALL SELECT model, 1, label, calibrated FROM x)
SELECT model, calibrated, round(avg(CAST(CAST(p >= 0.5 AS INTEGER) = label AS DOUBLE)), 6) AS accuracy,
       round(avg(pow(p - label, 2)), 6) AS brier, round({_ll('p')}, 6) AS logloss FROM l GROUP BY model, calibrated""")
def q_p13(spark, sf):
    x = bin_calibrate(scores(spark, sf), "proba", "label", "model")
    long = (x.select("model", F.lit(0).alias("calibrated"), "label", F.col("proba").alias("p"))
            .unionByName(x.select("model", F.lit(1).alias("calibrated"), "label", F.col("calibrated").alias("p"))))
    p, y = F.col("p"), F.col("label")
    return long.groupBy("model", "calibrated").agg(
        F.round(accuracy((p >= 0.5).cast("int"), y), 6).alias("accuracy"),
        F.round(brier(p, y), 6).alias("brier"), F.round(log_loss(p, y), 6).alias("logloss"))


PAIRS = S + """,
p AS (SELECT a.model AS item_a, b.model AS item_b, a.pred AS pa, b.pred AS pb, CAST(a.pred = a.label AS INTEGER) AS oa,
             CAST(b.pred = b.label AS INTEGER) AS ob FROM s a JOIN s b ON a.id = b.id AND a.model < b.model),
g AS (SELECT item_a, item_b, avg(CAST(pa = pb AS DOUBLE)) AS agreement,
        CAST(sum(CASE WHEN oa = 1 AND ob = 1 THEN 1 ELSE 0 END) AS BIGINT) AS both_right,
        CAST(sum(CASE WHEN oa = 0 AND ob = 0 THEN 1 ELSE 0 END) AS BIGINT) AS both_wrong,
        CAST(sum(CASE WHEN oa = 1 AND ob = 0 THEN 1 ELSE 0 END) AS BIGINT) AS only_a,
        CAST(sum(CASE WHEN oa = 0 AND ob = 1 THEN 1 ELSE 0 END) AS BIGINT) AS only_b,
        corr(CAST(pa AS DOUBLE), CAST(pb AS DOUBLE)) AS corr FROM p GROUP BY item_a, item_b)"""


def _pairs(spark, sf):
    return pair_diversity(_s(spark, sf))


@query("q_p14_pair_agreement", PAIRS + """
SELECT item_a, item_b, round(agreement, 6) AS agreement, round(1 - agreement, 6) AS disagreement FROM g""")
def q_p14(spark, sf):
    g = _pairs(spark, sf)
    return g.select("item_a", "item_b", F.round("agreement", 6).alias("agreement"),
                    F.round(F.lit(1.0) - F.col("agreement"), 6).alias("disagreement"))


@query("q_p15_q_statistic", PAIRS + """
SELECT item_a, item_b, both_right, both_wrong, only_a, only_b,
  round(CASE WHEN CAST(both_right AS DOUBLE) * both_wrong + CAST(only_a AS DOUBLE) * only_b <> 0
    THEN (CAST(both_right AS DOUBLE) * both_wrong - CAST(only_a AS DOUBLE) * only_b)
       / (CAST(both_right AS DOUBLE) * both_wrong + CAST(only_a AS DOUBLE) * only_b) END, 6) AS q_stat FROM g""")
def q_p15(spark, sf):
    g = _pairs(spark, sf)
    return g.select("item_a", "item_b", "both_right", "both_wrong", "only_a", "only_b", F.round("q_stat", 6).alias("q_stat"))


@query("q_p16_prediction_correlation", PAIRS + """
SELECT item_a, item_b, round(corr, 6) AS corr, round(1 - corr, 6) AS diversity,
       round(avg(corr) OVER (), 6) AS mean_corr FROM g""")
def q_p16(spark, sf):
    from pyspark.sql import Window
    g = _pairs(spark, sf)
    return g.select("item_a", "item_b", F.round("corr", 6).alias("corr"), F.round("diversity", 6).alias("diversity"),
                    F.round(F.avg("corr").over(Window.partitionBy()), 6).alias("mean_corr"))


@query("q_p17_groupwise_diversity", PAIRS + """
SELECT CASE WHEN item_a = 'm1' OR item_b = 'm1' THEN 'with_m1' ELSE 'without_m1' END AS grp,
       count(*) AS n_pairs, round(avg(1 - corr), 6) AS mean_diversity FROM g GROUP BY 1""")
def q_p17(spark, sf):
    g = _pairs(spark, sf)
    grp = F.when((F.col("item_a") == "m1") | (F.col("item_b") == "m1"), "with_m1").otherwise("without_m1")
    return g.groupBy(grp.alias("grp")).agg(F.count(F.lit(1)).alias("n_pairs"),
                                           F.round(F.avg("diversity"), 6).alias("mean_diversity"))


# Named model subsets compared as ensembles.
SUBSETS = {"m1+m2": ["m1", "m2"], "m1+m3": ["m1", "m3"], "m2+m3": ["m2", "m3"], "all": ["m1", "m2", "m3"]}


@query("q_p18_subset_comparison", PAIRS + ",\nsub AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', '{m}')" for n, ms in SUBSETS.items() for m in ms) + """) t(subset, model)),
v AS (SELECT sub.subset, s.id, any_value(s.label) AS label, avg(s.proba) AS p FROM s JOIN sub USING (model) GROUP BY sub.subset, s.id),
va AS (SELECT subset, avg(CAST(CAST(p >= 0.5 AS INTEGER) = label AS DOUBLE)) AS acc FROM v GROUP BY subset),
pc AS (SELECT a.subset, avg(g.corr) AS mean_corr FROM sub a JOIN sub b ON a.subset = b.subset AND a.model < b.model
       JOIN g ON g.item_a = a.model AND g.item_b = b.model GROUP BY a.subset)
SELECT subset, round(acc, 6) AS accuracy, round(mean_corr, 6) AS mean_corr FROM va JOIN pc USING (subset)""")
def q_p18(spark, sf):
    s = _s(spark, sf).persist()
    sub = spark.createDataFrame([(n, m) for n, ms in SUBSETS.items() for m in ms], "subset string, model string")
    v = s.join(F.broadcast(sub), "model").groupBy("subset", "id").agg(F.first("label").alias("label"),
                                                                       F.avg("proba").alias("p"))
    va = v.groupBy("subset").agg(accuracy((F.col("p") >= 0.5).cast("int"), F.col("label")).alias("acc"))
    g = pair_diversity(s)
    a, b = sub.alias("a"), sub.alias("b")
    pr = a.join(b, (F.col("a.subset") == F.col("b.subset")) & (F.col("a.model") < F.col("b.model"))).select(
        F.col("a.subset").alias("subset"), F.col("a.model").alias("item_a"), F.col("b.model").alias("item_b"))
    pc = pr.join(g, ["item_a", "item_b"]).groupBy("subset").agg(F.avg("corr").alias("mean_corr"))
    return va.join(pc, "subset").select("subset", F.round("acc", 6).alias("accuracy"),
                                        F.round("mean_corr", 6).alias("mean_corr"))


@query("q_p19_ensemble_vs_members", S + ", " + ACC + """,
ens AS (SELECT 'soft_vote' AS method, avg(CAST(CAST(p >= 0.5 AS INTEGER) = label AS DOUBLE)) AS acc FROM
          (SELECT id, any_value(label) AS label, avg(proba) AS p FROM s GROUP BY id)
        UNION ALL SELECT 'hard_vote', avg(CAST(v = label AS DOUBLE)) FROM
          (SELECT id, any_value(label) AS label, CAST(avg(CAST(pred AS DOUBLE)) > 0.5 AS INTEGER) AS v FROM s GROUP BY id)),
allm AS (SELECT model AS method, acc, 0 AS is_ensemble FROM acc UNION ALL SELECT method, acc, 1 FROM ens)
SELECT method, round(acc, 6) AS accuracy, is_ensemble,
       CAST(is_ensemble = 1 AND acc < (SELECT max(acc) FROM acc) AS INTEGER) AS below_best FROM allm""")
def q_p19(spark, sf):
    s = _s(spark, sf).persist()
    acc = _acc(s).select(F.col("model").alias("method"), "acc", F.lit(0).alias("is_ensemble"))
    labels = s.where(F.col("model") == "m1").select("id", "label")
    sv = soft_vote(s).join(labels, "id").agg(accuracy(F.col("vote"), F.col("label")).alias("acc"))
    hv = hard_vote(s).join(labels, "id").agg(accuracy(F.col("vote"), F.col("label")).alias("acc"))
    ens = (sv.select(F.lit("soft_vote").alias("method"), "acc", F.lit(1).alias("is_ensemble"))
           .unionByName(hv.select(F.lit("hard_vote").alias("method"), "acc", F.lit(1).alias("is_ensemble"))))
    best = acc.agg(F.max("acc").alias("_best"))
    allm = acc.unionByName(ens).crossJoin(best)
    return allm.select("method", F.round("acc", 6).alias("accuracy"), "is_ensemble",
                       ((F.col("is_ensemble") == 1) & (F.col("acc") < F.col("_best"))).cast("int").alias("below_best"))
