"""Metrics (N*) on the ``scores`` long prediction table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.operators.ensemble import with_pred
from tabforge.operators.metrics import (bin_calibrate, binary_metrics, brier, classification_report,
                                        confusion_counts, curve_points, f1_threshold, log_loss, pr_points, roc_auc,
                                        roc_points, threshold_sweep, youden_threshold)
from tabforge.plans.fixtures import scores
from tabforge.plans.registry import query

PRED = "(CASE WHEN proba >= 0.5 THEN 1 ELSE 0 END)"
COUNTS = ("c AS (SELECT model, proba, CAST(sum(label) AS BIGINT) AS pos, CAST(count(*) - sum(label) AS BIGINT) AS neg "
          "FROM scores GROUP BY model, proba)")
CURVE = COUNTS + """,
r AS (SELECT c.*, sum(pos) OVER (PARTITION BY model ORDER BY proba DESC) AS cum_pos,
             sum(neg) OVER (PARTITION BY model ORDER BY proba DESC) AS cum_neg,
             sum(pos) OVER (PARTITION BY model) AS "P", sum(neg) OVER (PARTITION BY model) AS "N" FROM c),
roc AS (SELECT model, proba AS threshold, CAST(cum_neg AS DOUBLE) / "N" AS fpr, CAST(cum_pos AS DOUBLE) / "P" AS tpr FROM r
        UNION ALL SELECT DISTINCT model, CAST('inf' AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM c),
pr AS (SELECT model, proba AS threshold, CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg) AS precision,
              CAST(cum_pos AS DOUBLE) / "P" AS recall FROM r),
yd AS (SELECT model, arg_max(threshold, struct_pack(j := tpr - fpr, t := threshold)) AS threshold,
              max(tpr - fpr) AS youden FROM roc GROUP BY model),
f1t AS (SELECT model, arg_max(threshold, struct_pack(f := 2 * precision * recall / (precision + recall + 1e-10), t := -threshold)) AS threshold
        FROM pr GROUP BY model)"""

RATES = """CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
  CASE WHEN tp + fp > 0 AND tp + fn > 0 AND tp > 0 THEN 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)) ELSE 0 END AS f1,
  CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS recall_neg"""

# Named candidate thresholds (order = report order).
NAMED_THRESHOLDS = [("default", 0.5, 0), ("high_recall", 0.4, 3), ("high_precision", 0.6, 4), ("balanced", 0.45, 5)]

SWEEP = CURVE + """,
th AS (SELECT m.model, t.name, CAST(t.threshold AS DOUBLE) AS threshold, t.ord FROM (SELECT DISTINCT model FROM c) m CROSS JOIN
       (VALUES """ + ", ".join(f"('{n}', {t}, {o})" for n, t, o in NAMED_THRESHOLDS) + """) t(name, threshold, ord)
       UNION ALL SELECT model, 'youden', threshold, 1 FROM yd UNION ALL SELECT model, 'f1', threshold, 2 FROM f1t),
cnt AS (SELECT th.model, th.name, th.threshold, th.ord,
          CAST(sum(CASE WHEN proba >= th.threshold THEN pos ELSE 0 END) AS DOUBLE) AS tp,
          CAST(sum(CASE WHEN proba >= th.threshold THEN neg ELSE 0 END) AS DOUBLE) AS fp,
          CAST(sum(CASE WHEN proba < th.threshold THEN neg ELSE 0 END) AS DOUBLE) AS tn,
          CAST(sum(CASE WHEN proba < th.threshold THEN pos ELSE 0 END) AS DOUBLE) AS fn
        FROM c JOIN th ON c.model = th.model GROUP BY th.model, th.name, th.threshold, th.ord),
sw AS (SELECT model, name, threshold, ord, (tp + tn) / (tp + tn + fp + fn) AS accuracy, """ + RATES + """ FROM cnt)"""


def _s(spark, sf):
    return with_pred(scores(spark, sf))


def _thresholds(spark, s):
    models = s.select("model").distinct()
    named = spark.createDataFrame(NAMED_THRESHOLDS, "name string, threshold double, ord int")
    pts = curve_points(s, "proba", "label", "model").persist()  # one curve for both optima
    y = youden_threshold(s, "proba", "label", "model", pts).select("model", F.lit("youden").alias("name"), "threshold",
                                                               F.lit(1).alias("ord"))
    f = f1_threshold(s, "proba", "label", "model", points=pts).select("model", F.lit("f1").alias("name"), "threshold",
                                                          F.lit(2).alias("ord"))
    return models.crossJoin(F.broadcast(named)).select("model", "name", "threshold", "ord").unionByName(y).unionByName(f)


def _sweep(spark, sf):
    s = scores(spark, sf).persist()
    th = _thresholds(spark, s)
    sw = threshold_sweep(s, "proba", "label", th.drop("ord"), "model")
    return sw.join(th.select("model", "name", "ord"), ["model", "name"])


R6 = ["accuracy", "precision", "recall", "f1", "recall_neg"]


@query("q_n1_accuracy", f"""
SELECT model, round(avg(CAST({PRED} = label AS DOUBLE)), 6) AS accuracy FROM scores GROUP BY model""")
def q_n1(spark, sf):
    return binary_metrics(_s(spark, sf), "label", "pred", "model").select("model", F.round("accuracy", 6).alias("accuracy"))


@query("q_n2_roc_auc_ties", f"""
WITH {COUNTS}, r AS (SELECT c.*, sum(neg) OVER (PARTITION BY model ORDER BY proba) AS cum_neg FROM c)
SELECT model, round(sum(pos * (cum_neg - neg + neg * 0.5)) / (sum(pos) * sum(neg)), 6) AS auc FROM r GROUP BY model""")
def q_n2(spark, sf):
    return roc_auc(scores(spark, sf), "proba", "label", "model").select("model", F.round("auc", 6).alias("auc"))


@query("q_n3_roc_points", f"""
WITH {CURVE} SELECT model, threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM roc""")
def q_n3(spark, sf):
    r = roc_points(scores(spark, sf), "proba", "label", "model")
    return r.select("model", "threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@query("q_n4_pr_points", f"""
WITH {CURVE} SELECT model, threshold, round(precision, 6) AS precision, round(recall, 6) AS recall FROM pr""")
def q_n4(spark, sf):
    p = pr_points(scores(spark, sf), "proba", "label", "model")
    return p.select("model", "threshold", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


BIN_SQL = f"""
WITH t AS (SELECT model, CAST(sum(CASE WHEN label = 1 AND {PRED} = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
  CAST(sum(CASE WHEN label = 0 AND {PRED} = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
  CAST(sum(CASE WHEN label = 0 AND {PRED} = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn,
  CAST(sum(CASE WHEN label = 1 AND {PRED} = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn FROM scores GROUP BY model),
m AS (SELECT model, (tp + tn) / (tp + tn + fp + fn) AS accuracy, {RATES} FROM t)"""


@query("q_n5_precision_recall_f1", BIN_SQL + """
SELECT model, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM m""")
def q_n5(spark, sf):
    m = binary_metrics(_s(spark, sf), "label", "pred", "model")
    return m.select("model", *[F.round(c, 6).alias(c) for c in ["precision", "recall", "f1"]])


@query("q_n6_confusion_matrix", f"""
SELECT model, label, {PRED} AS pred, count(*) AS n FROM scores GROUP BY ALL""")
def q_n6(spark, sf):
    return confusion_counts(_s(spark, sf), "label", "pred", "model")


@query("q_n7_per_class_recall", BIN_SQL + """
SELECT model, round(recall_neg, 6) AS recall_neg, round(recall, 6) AS recall_pos FROM m""")
def q_n7(spark, sf):
    m = binary_metrics(_s(spark, sf), "label", "pred", "model")
    return m.select("model", F.round("recall_neg", 6).alias("recall_neg"), F.round("recall_pos", 6).alias("recall_pos"))


@query("q_n8_classification_report", BIN_SQL + """,
k AS (SELECT model, precision AS p1, recall AS r1, f1 AS f1_, CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END AS p0,
             recall_neg AS r0, tp + fn AS s1, tn + fp AS s0, tp + tn + fp + fn AS n, accuracy FROM m JOIN t USING (model)),
k2 AS (SELECT *, CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0 END AS f0 FROM k)
SELECT model, row, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM (
  SELECT model, '0' AS row, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM k2
  UNION ALL SELECT model, '1', p1, r1, f1_, s1 FROM k2
  UNION ALL SELECT model, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1_) / 2, n FROM k2
  UNION ALL SELECT model, 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1_ * s1) / n, n FROM k2
  UNION ALL SELECT model, 'accuracy', NULL, NULL, accuracy, n FROM k2)""")
def q_n8(spark, sf):
    r = classification_report(_s(spark, sf), "label", "pred", "model")
    return r.select("model", "row", *[F.round(c, 6).alias(c) for c in ["precision", "recall", "f1"]], "support")


CAL_SQL = """
WITH b AS (SELECT *, CAST(least(floor(proba * 10), 9) AS INTEGER) AS bin FROM scores),
rt AS (SELECT model, bin, avg(CAST(label AS DOUBLE)) AS calibrated FROM b GROUP BY model, bin),
x AS (SELECT b.*, rt.calibrated FROM b JOIN rt USING (model, bin))"""


@query("q_n9_brier_improvement", CAL_SQL + """
SELECT model, round(avg(pow(proba - label, 2)), 6) AS brier_raw, round(avg(pow(calibrated - label, 2)), 6) AS brier_cal,
       round(avg(pow(proba - label, 2)) - avg(pow(calibrated - label, 2)), 6) AS improvement FROM x GROUP BY model""")
def q_n9(spark, sf):
    x = bin_calibrate(scores(spark, sf), "proba", "label", "model")
    g = x.groupBy("model").agg(brier(F.col("proba"), F.col("label")).alias("r"),
                               brier(F.col("calibrated"), F.col("label")).alias("c"))
    return g.select("model", F.round("r", 6).alias("brier_raw"), F.round("c", 6).alias("brier_cal"),
                    F.round(F.col("r") - F.col("c"), 6).alias("improvement"))


def _ll_sql(p):
    q = f"least(greatest({p}, 1e-15), 1 - 1e-15)"
    return f"avg(-(CAST(label AS DOUBLE) * ln({q}) + (1 - CAST(label AS DOUBLE)) * ln(1 - {q})))"


@query("q_n10_log_loss_improvement", CAL_SQL + f"""
SELECT model, round({_ll_sql('proba')}, 6) AS logloss_raw, round({_ll_sql('calibrated')}, 6) AS logloss_cal,
       round({_ll_sql('proba')} - {_ll_sql('calibrated')}, 6) AS improvement FROM x GROUP BY model""")
def q_n10(spark, sf):
    x = bin_calibrate(scores(spark, sf), "proba", "label", "model")
    g = x.groupBy("model").agg(log_loss(F.col("proba"), F.col("label")).alias("r"),
                               log_loss(F.col("calibrated"), F.col("label")).alias("c"))
    return g.select("model", F.round("r", 6).alias("logloss_raw"), F.round("c", 6).alias("logloss_cal"),
                    F.round(F.col("r") - F.col("c"), 6).alias("improvement"))


@query("q_n11_youden_threshold", f"""
WITH {CURVE} SELECT yd.model, yd.threshold, round(yd.youden, 6) AS youden FROM yd""")
def q_n11(spark, sf):
    y = youden_threshold(scores(spark, sf), "proba", "label", "model")
    return y.select("model", "threshold", F.round("youden", 6).alias("youden"))


@query("q_n12_f1_threshold", f"""
WITH {CURVE} SELECT f1t.model, f1t.threshold FROM f1t""")
def q_n12(spark, sf):
    return f1_threshold(scores(spark, sf), "proba", "label", "model").select("model", "threshold")


@query("q_n13_threshold_sweep", f"""
WITH {SWEEP}
SELECT model, name, threshold, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, round(recall_neg, 6) AS recall_neg FROM sw""")
def q_n13(spark, sf):
    sw = _sweep(spark, sf)
    return sw.select("model", "name", "threshold", *[F.round(c, 6).alias(c) for c in R6])


@query("q_n14_best_threshold_choice", f"""
WITH {SWEEP}
SELECT model, arg_max(name, struct_pack(a := accuracy, o := -ord)) AS best_name,
       arg_max(threshold, struct_pack(a := accuracy, o := -ord)) AS best_threshold FROM sw GROUP BY model""")
def q_n14(spark, sf):
    sw = _sweep(spark, sf)
    b = sw.groupBy("model").agg(F.max(F.struct(F.col("accuracy"), (-F.col("ord")).alias("o"), "name", "threshold")).alias("b"))
    return b.select("model", F.col("b.name").alias("best_name"), F.col("b.threshold").alias("best_threshold"))


@query("q_n15_apply_threshold", """
SELECT model, count(*) FILTER (WHERE proba >= 0.5) AS n_pos_ge, count(*) FILTER (WHERE proba > 0.5) AS n_pos_gt FROM scores GROUP BY model""")
def q_n15(spark, sf):
    s = with_pred(with_pred(scores(spark, sf), out="ge"), inclusive=False, out="gt")
    return s.groupBy("model").agg(F.sum("ge").cast("long").alias("n_pos_ge"), F.sum("gt").cast("long").alias("n_pos_gt"))


@query("q_n16_predicted_positive_rate", f"""
SELECT model, round(avg(CAST({PRED} AS DOUBLE)), 6) AS positive_rate FROM scores GROUP BY model""")
def q_n16(spark, sf):
    return _s(spark, sf).groupBy("model").agg(F.round(F.avg(F.col("pred").cast("double")), 6).alias("positive_rate"))


@query("q_n17_baseline_vs_optimal_delta", f"""
WITH {SWEEP},
best AS (SELECT model, arg_max(name, struct_pack(a := accuracy, o := -ord)) AS name FROM sw GROUP BY model)
SELECT o.model, o.name AS best_name, round(o.accuracy - d.accuracy, 6) AS d_accuracy, round(o.f1 - d.f1, 6) AS d_f1,
       round(o.recall - d.recall, 6) AS d_recall FROM sw o JOIN best USING (model, name) JOIN sw d ON d.model = o.model AND d.name = 'default'""")
def q_n17(spark, sf):
    sw = _sweep(spark, sf).persist()
    b = sw.groupBy("model").agg(F.max(F.struct(F.col("accuracy"), (-F.col("ord")).alias("o"), "name")).alias("b")) \
        .select("model", F.col("b.name").alias("name"))
    o = sw.join(b, ["model", "name"])
    d = sw.where(F.col("name") == "default").select("model", *[F.col(c).alias(f"d_{c}") for c in ["accuracy", "f1", "recall"]])
    j = o.join(d, "model")
    return j.select("model", F.col("name").alias("best_name"),
                    *[F.round(F.col(c) - F.col(f"d_{c}"), 6).alias(f"d_{c}") for c in ["accuracy", "f1", "recall"]])
