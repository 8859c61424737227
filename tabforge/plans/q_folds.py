"""Fold assignment (M1-M5) and model-selection tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.operators.ensemble import with_pred
from tabforge.operators.folds import (balanced_group_folds, fold_balance, group_folds, group_profile, repeated_stratified_folds,
                                      stratified_folds)
from tabforge.operators.metrics import binary_metrics, roc_auc
from tabforge.operators.selection import (composite_score, constrained_best, penalised_best, seed_count_curve,
                                          stability, with_gap)
from tabforge.plans.fixtures import base, scores, seeded_scores
from tabforge.plans.q_relational import FOLD_SQL
from tabforge.plans.registry import query


@query("q_m1_stratified_folds", f"""
SELECT fold, label, count(*) AS n FROM (SELECT label, {FOLD_SQL} AS fold FROM base) GROUP BY fold, label""")
def q_m1(spark, sf):
    f = stratified_folds(base(spark, sf).select("id", "label"), "id", "label")
    return f.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n"))


@query("q_m2_repeated_stratified_folds", """
WITH r AS (SELECT b.id, b.label, rep.r AS "repeat" FROM base b CROSS JOIN (SELECT unnest(range(0, 3)) AS r) rep),
f AS (SELECT "repeat", label, CAST((row_number() OVER (PARTITION BY "repeat", label
        ORDER BY md5(concat('42-', CAST("repeat" AS VARCHAR), ':', CAST(id AS VARCHAR))), id) - 1) % 5 AS INTEGER) AS fold FROM r)
SELECT "repeat", fold, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives FROM f GROUP BY ALL""")
def q_m2(spark, sf):
    f = repeated_stratified_folds(base(spark, sf).select("id", "label"), "id", "label", 5, 3)
    return fold_balance(f.withColumn("repeat", F.col("repeat").cast("long")), "label", keys="repeat")


def _snake_sql(order, k=5):
    return (f"CAST(CASE WHEN (row_number() OVER (ORDER BY {order}) - 1) % {2 * k} < {k} "
            f"THEN (row_number() OVER (ORDER BY {order}) - 1) % {2 * k} "
            f"ELSE {2 * k - 1} - (row_number() OVER (ORDER BY {order}) - 1) % {2 * k} END AS INTEGER)")


@query("q_m3_group_kfold", f"""
WITH g AS (SELECT ticket, count(*) AS size FROM base GROUP BY ticket),
f AS (SELECT ticket, size, {_snake_sql('size DESC, ticket')} AS fold FROM g)
SELECT fold, CAST(sum(size) AS BIGINT) AS n_rows, count(*) AS n_groups FROM f GROUP BY fold""")
def q_m3(spark, sf):
    f = group_folds(base(spark, sf).select("id", "ticket"), "ticket", 5)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("ticket").alias("n_groups"))


@query("q_m4_stratified_group_kfold", f"""
WITH g AS (SELECT ticket, count(*) AS size, CAST(sum(label) AS BIGINT) AS pos FROM base GROUP BY ticket),
f AS (SELECT ticket, size, pos, {_snake_sql('pos DESC, size DESC, ticket')} AS fold FROM g)
SELECT fold, CAST(sum(size) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS positives FROM f GROUP BY fold""")
def q_m4(spark, sf):
    f = group_folds(base(spark, sf).select("id", "ticket", "label"), "ticket", 5, label="label")
    return fold_balance(f, "label").select("fold", "n", "positives")


def _greedy_sql(pos, k=5):
    """Group by group: each goes to the fold where it adds least to the squared deviation of the class counts."""
    load = "CAST(ps[f] AS HUGEINT) * g.pos * tn * tn + CAST(ns[f] AS HUGEINT) * g.neg * tp * tp"
    return f"""
WITH RECURSIVE g AS (SELECT ticket, pos, size - pos AS neg, row_number() OVER (ORDER BY size DESC, pos DESC, ticket) AS nth
  FROM (SELECT ticket, count(*) AS size, {pos} AS pos FROM base WHERE ticket IS NOT NULL GROUP BY ticket)),
tot AS (SELECT greatest(1, sum(pos)) AS tp, greatest(1, sum(neg)) AS tn FROM g),
walk AS (SELECT CAST(0 AS BIGINT) AS nth, 0 AS fold, [CAST(0 AS BIGINT) FOR x IN range({k})] AS ps, [CAST(0 AS BIGINT) FOR x IN range({k})] AS ns
  UNION ALL
  SELECT nth, fold, [CASE WHEN f = fold THEN ps[f] + pos ELSE ps[f] END FOR f IN range(1, {k + 1})],
         [CASE WHEN f = fold THEN ns[f] + neg ELSE ns[f] END FOR f IN range(1, {k + 1})]
  FROM (SELECT g.nth, g.pos, g.neg, ps, ns, list_position(loads, list_min(loads)) AS fold
        FROM (SELECT g.nth, g.pos, g.neg, ps, ns, [{load} FOR f IN range(1, {k + 1})] AS loads
              FROM walk JOIN g ON g.nth = walk.nth + 1 CROSS JOIN tot) AS g))"""


@query("q_m3_lightest_fold", _greedy_sql("CAST(0 AS BIGINT)") + """
SELECT CAST(fold - 1 AS INTEGER) AS fold, pos + neg AS size, count(*) AS n_groups FROM walk JOIN g USING (nth) GROUP BY ALL""")
def q_m3_lightest(spark, sf):
    f = balanced_group_folds(base(spark, sf).where(F.col("ticket").isNotNull()).select("ticket"), "ticket", 5)
    return (f.groupBy("ticket", "fold").agg(F.count(F.lit(1)).alias("size"))
            .groupBy("fold", "size").agg(F.count(F.lit(1)).alias("n_groups")))


@query("q_m4_balanced_group_folds", _greedy_sql("CAST(sum(label) AS BIGINT)") + """
SELECT CAST(fold - 1 AS INTEGER) AS fold, CAST(sum(pos + neg) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS positives, count(*) AS n_groups
FROM walk JOIN g USING (nth) GROUP BY fold""")
def q_m4_balanced(spark, sf):
    f = balanced_group_folds(base(spark, sf).where(F.col("ticket").isNotNull()).select("ticket", "label"), "ticket", 5, label="label")
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("label").cast("long").alias("positives"),
                                 F.count_distinct("ticket").alias("n_groups"))


@query("q_m5_group_size_profile", """
SELECT size, count(*) AS n_groups, CAST(sum(size) AS BIGINT) AS n_rows FROM (SELECT ticket, count(*) AS size FROM base GROUP BY ticket)
GROUP BY size""")
def q_m5(spark, sf):
    return group_profile(base(spark, sf), "ticket")


@query("q_m8_oof_accuracy_auc", """
WITH c AS (SELECT model, proba, CAST(sum(label) AS BIGINT) AS pos, CAST(count(*) - sum(label) AS BIGINT) AS neg FROM scores GROUP BY model, proba),
r AS (SELECT c.*, sum(neg) OVER (PARTITION BY model ORDER BY proba) AS cum_neg FROM c),
auc AS (SELECT model, sum(pos * (cum_neg - neg + neg * 0.5)) / (sum(pos) * sum(neg)) AS auc FROM r GROUP BY model),
acc AS (SELECT model, avg(CAST(CAST(proba >= 0.5 AS INTEGER) = label AS DOUBLE)) AS accuracy FROM scores GROUP BY model)
SELECT model, round(accuracy, 6) AS accuracy, round(auc, 6) AS auc FROM acc JOIN auc USING (model)""")
def q_m8(spark, sf):
    s = scores(spark, sf)
    acc = binary_metrics(with_pred(s), "label", "pred", "model").select("model", "accuracy")
    return acc.join(roc_auc(s, "proba", "label", "model"), "model").select(
        "model", F.round("accuracy", 6).alias("accuracy"), F.round("auc", 6).alias("auc"))


@query("q_m9_fold_averaged_prediction", """
SELECT model, id, round(avg(proba), 6) AS proba FROM seeded GROUP BY model, id""")
def q_m9(spark, sf):
    return seeded_scores(spark, sf).groupBy("model", "id").agg(F.round(F.avg("proba"), 6).alias("proba"))


# Per-(model, seed) scores play the fold scores; the unjittered accuracy plays the train score.
RES_SQL = """
fs AS (SELECT model, seed AS fold, avg(CAST(CAST(proba >= 0.5 AS INTEGER) = label AS DOUBLE)) AS score FROM seeded GROUP BY model, seed),
tr AS (SELECT model, avg(CAST(CAST(proba >= 0.45 AS INTEGER) = label AS DOUBLE)) AS train_score FROM scores GROUP BY model),
st AS (SELECT model, avg(score) AS cv_score, stddev_pop(score) AS cv_std, min(score) AS mn, max(score) AS mx,
              arg_min(fold, struct_pack(s := score, f := fold)) AS worst_fold FROM fs GROUP BY model),
res AS (SELECT model, train_score, cv_score, cv_std, train_score - cv_score AS gap,
               (train_score - cv_score) * 100.0 / train_score AS gap_pct FROM tr JOIN st USING (model))"""


def _fold_scores(spark, sf):
    s = with_pred(seeded_scores(spark, sf))
    return s.groupBy("model", F.col("seed").alias("fold")).agg(
        F.avg((F.col("pred") == F.col("label")).cast("double")).alias("score"))


def _results(spark, sf):
    st = stability(_fold_scores(spark, sf)).select("model", F.col("mean").alias("cv_score"), F.col("std").alias("cv_std"))
    tr = with_pred(scores(spark, sf), threshold=0.45).groupBy("model").agg(
        F.avg((F.col("pred") == F.col("label")).cast("double")).alias("train_score"))
    return with_gap(tr.join(st, "model")).persist()


@query("q_m10_train_cv_gap", f"""
WITH {RES_SQL} SELECT model, round(gap, 6) AS gap, round(gap_pct, 6) AS gap_pct FROM res""")
def q_m10(spark, sf):
    return _results(spark, sf).select("model", F.round("gap", 6).alias("gap"), F.round("gap_pct", 6).alias("gap_pct"))


@query("q_m17_constrained_selection", f"""
WITH {RES_SQL},
ok AS (SELECT arg_max(model, struct_pack(c := cv_score, g := -gap, m := model)) AS m FROM res WHERE gap < 0.02),
fb AS (SELECT arg_min(model, struct_pack(g := gap, c := -cv_score, m := model)) AS m FROM res)
SELECT coalesce(ok.m, fb.m) AS chosen, CASE WHEN ok.m IS NOT NULL THEN 'within_gap' ELSE 'min_gap' END AS rule FROM ok CROSS JOIN fb""")
def q_m17(spark, sf):
    return constrained_best(_results(spark, sf), max_gap=0.02)


@query("q_m18_penalised_selection", f"""
WITH {RES_SQL}
SELECT arg_max(model, struct_pack(p := cv_score - 2 * gap, m := model)) AS chosen, round(max(cv_score - 2 * gap), 6) AS penalised FROM res""")
def q_m18(spark, sf):
    p = penalised_best(_results(spark, sf), 2.0)
    return p.select("chosen", F.round("penalised", 6).alias("penalised"))


@query("q_m19_composite_score", f"""
WITH {RES_SQL}
SELECT model, round(0.5 * cv_score + 0.3 / (1 + cv_std) + 0.2 / (1 + gap), 6) AS composite FROM res""")
def q_m19(spark, sf):
    r = _results(spark, sf)
    return r.select("model", F.round(composite_score("cv_score", "cv_std", "gap"), 6).alias("composite"))


@query("q_m20_stability_table", f"""
WITH {RES_SQL}
SELECT model, round(cv_score, 6) AS mean, round(cv_std, 6) AS std, round(mn, 6) AS min, round(mx, 6) AS max,
       round(mx - mn, 6) AS range, worst_fold FROM st""")
def q_m20(spark, sf):
    s = stability(_fold_scores(spark, sf))
    return s.select("model", *[F.round(c, 6).alias(c) for c in ["mean", "std", "min", "max", "range"]], "worst_fold")


@query("q_m21_expected_external_score", f"""
WITH {RES_SQL}
SELECT model, round(cv_score - 0.05, 6) AS expected_const, round(cv_score * (1 - gap / train_score), 6) AS expected_ratio FROM res""")
def q_m21(spark, sf):
    r = _results(spark, sf)
    return r.select("model", F.round(F.col("cv_score") - F.lit(0.05), 6).alias("expected_const"),
                    F.round(F.col("cv_score") * (F.lit(1.0) - F.col("gap") / F.col("train_score")), 6).alias("expected_ratio"))


@query("q_m23_target_check", f"""
WITH {RES_SQL}
SELECT model, CAST(cv_score >= 0.8 AS INTEGER) AS cv_ok, CAST(abs(gap) <= 0.02 AS INTEGER) AS gap_ok,
       CAST(cv_score >= 0.8 AND abs(gap) <= 0.02 AS INTEGER) AS passed FROM res""")
def q_m23(spark, sf):
    r = _results(spark, sf)
    cv_ok, gap_ok = F.col("cv_score") >= 0.8, F.abs("gap") <= 0.02
    return r.select("model", cv_ok.cast("int").alias("cv_ok"), gap_ok.cast("int").alias("gap_ok"),
                    (cv_ok & gap_ok).cast("int").alias("passed"))


@query("q_m25_seed_count_returns", """
WITH ns AS (SELECT unnest([1, 2, 3]) AS n_seeds),
per AS (SELECT model, n_seeds, id, avg(proba) AS p, stddev_pop(proba) AS sd, any_value(label) AS y
        FROM seeded JOIN ns ON seed < n_seeds GROUP BY model, n_seeds, id),
g AS (SELECT model, n_seeds, avg(CAST(CAST(p >= 0.5 AS INTEGER) = y AS DOUBLE)) AS accuracy, avg(sd) AS mean_std, max(sd) AS max_std
      FROM per GROUP BY model, n_seeds)
SELECT model, CAST(n_seeds AS INTEGER) AS n_seeds, round(accuracy, 6) AS accuracy, round(mean_std, 6) AS mean_std, round(max_std, 6) AS max_std,
       round(gain, 6) AS gain, CAST(gain < 0.5 * lag(gain) OVER (PARTITION BY model ORDER BY n_seeds) AS INTEGER) AS diminishing
FROM (SELECT *, accuracy - lag(accuracy) OVER (PARTITION BY model ORDER BY n_seeds) AS gain FROM g)""")
def q_m25(spark, sf):
    c = seed_count_curve(seeded_scores(spark, sf), [1, 2, 3])
    return c.select("model", "n_seeds", *[F.round(x, 6).alias(x) for x in ["accuracy", "mean_std", "max_std", "gain"]],
                    "diminishing")


# Seed counts of the study.
SEED_COUNTS = [1, 5, 10, 20, 30]


@query("q_m25_seed_count_returns_30", f"""
WITH ns AS (SELECT unnest({SEED_COUNTS}) AS n_seeds),
sd AS (SELECT id, model, label, seed, least(CAST(1 AS DOUBLE), greatest(CAST(0 AS DOUBLE),
        proba + CAST((id * (seed + 3)) % 5 - 2 AS DOUBLE) / CAST(1000 AS DOUBLE))) AS proba
       FROM scores CROSS JOIN (SELECT unnest(range(0, {max(SEED_COUNTS)})) AS seed)),
per AS (SELECT model, n_seeds, id, 2 * sum(CAST(round(1000 * proba) AS BIGINT)) >= 1000 * count(*) AS p, stddev_pop(proba) AS sd, any_value(label) AS y
        FROM sd JOIN ns ON seed < n_seeds GROUP BY model, n_seeds, id),
g AS (SELECT model, n_seeds, avg(CAST(CAST(p AS INTEGER) = y AS DOUBLE)) AS accuracy, avg(sd) AS mean_std, max(sd) AS max_std
      FROM per GROUP BY model, n_seeds)
SELECT model, CAST(n_seeds AS INTEGER) AS n_seeds, round(accuracy, 6) AS accuracy, round(mean_std, 6) AS mean_std, round(max_std, 6) AS max_std,
       round(gain, 6) AS gain, CAST(gain < 0.5 * lag(gain) OVER (PARTITION BY model ORDER BY n_seeds) AS INTEGER) AS diminishing
FROM (SELECT *, accuracy - lag(accuracy) OVER (PARTITION BY model ORDER BY n_seeds) AS gain FROM g)""")
def q_m25_30(spark, sf):
    # scores are whole thousandths: as decimals their means are exact at the threshold
    x = seeded_scores(spark, sf, max(SEED_COUNTS)).withColumn("proba", F.col("proba").cast("decimal(6,3)"))
    c = seed_count_curve(x, SEED_COUNTS)
    return c.select("model", "n_seeds", *[F.round(x, 6).alias(x) for x in ["accuracy", "mean_std", "max_std", "gain"]],
                    "diminishing")
