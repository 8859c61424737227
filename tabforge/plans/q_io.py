"""Sources and sinks (A*) as write-then-read round trips in a fresh folder
under the shared checkpoint location; each returns what was read back."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tabforge.operators.common import checked_broadcast
from tabforge.operators.metrics import youden_threshold
from tabforge.plans.fixtures import base, scores
from tabforge.plans.registry import query
from tabforge.sources.files import (append_run_record, prediction_path, read_csv, read_json, read_model_params, scratch_path,
                                    write_json_summary, write_predictions, write_table)

CSV_SCHEMA = "id long, full_name string, quoted string, amount_a double, n_sib int"


@query("q_a1_csv_scan_quoted", """
SELECT id, full_name, '"' || klass || '", ' || category AS quoted, amount_a, n_sib FROM base""")
def q_a1(spark, sf):
    b = base(spark, sf).select("id", "full_name", F.concat(F.lit('"'), F.col("klass"), F.lit('", '), F.col("category"))
                               .alias("quoted"), "amount_a", "n_sib")
    path = scratch_path(spark, "csv")
    write_table(b, path, fmt="csv")
    return read_csv(spark, path, CSV_SCHEMA)


@query("q_a2_table_sink", "SELECT id, klass, category, amount_b, label FROM base")
def q_a2(spark, sf):
    path = scratch_path(spark, "table")
    write_table(base(spark, sf).select("id", "klass", "category", "amount_b", "label"), path, partition_by=["category"])
    return spark.read.parquet(path).select("id", "klass", "category", "amount_b", "label")


@query("q_a3_validated_prediction_sink", "SELECT id, label FROM base WHERE origin = 'serve'")
def q_a3(spark, sf):
    serve = base(spark, sf).where(F.col("origin") == "serve").select("id", "label", "amount_b")
    path = scratch_path(spark, "predictions")
    write_predictions(serve, path, ["id", "label"], suffix=".csv", stamp="20250131_0930")
    return read_csv(spark, prediction_path(path, ".csv", "20250131_0930"), "id long, label int")


@query("q_a4_json_summary_sink", """
SELECT category, count(*) AS n, round(avg(CAST(label AS DOUBLE)), 6) AS rate, round(median(amount_b), 6) AS median_amount
FROM base GROUP BY category""")
def q_a4(spark, sf):
    from tabforge.operators.quantiles import group_quantiles
    b = base(spark, sf)
    g = b.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("label").cast("double")).alias("rate"))
    g = g.join(group_quantiles(b, "amount_b", [0.5], ["category"], ["median_amount"]), "category")
    nested = g.select("category", F.struct("n", F.struct(F.round("rate", 6).alias("rate"),
                                                         F.round("median_amount", 6).alias("median_amount")).alias("stats"))
                      .alias("summary"))
    path = scratch_path(spark, "summary")
    write_json_summary(nested, path)
    back = read_json(spark, path, "category string, summary struct<n: long, stats: struct<rate: double, median_amount: double>>",
                     multiline=False)
    return back.select("category", "summary.n", "summary.stats.rate", "summary.stats.median_amount")


@query("q_a5_json_param_source", """
WITH c AS (SELECT model, proba, CAST(sum(label) AS BIGINT) AS pos, CAST(count(*) - sum(label) AS BIGINT) AS neg FROM scores GROUP BY model, proba),
r AS (SELECT c.*, sum(pos) OVER (PARTITION BY model ORDER BY proba DESC) AS cum_pos, sum(neg) OVER (PARTITION BY model ORDER BY proba DESC) AS cum_neg,
             sum(pos) OVER (PARTITION BY model) AS "P", sum(neg) OVER (PARTITION BY model) AS "N" FROM c),
roc AS (SELECT model, proba AS threshold, CAST(cum_neg AS DOUBLE) / "N" AS fpr, CAST(cum_pos AS DOUBLE) / "P" AS tpr FROM r
        UNION ALL SELECT DISTINCT model, CAST('inf' AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM c),
yd AS (SELECT model, arg_max(threshold, struct_pack(j := tpr - fpr, t := threshold)) AS threshold FROM roc GROUP BY model)
SELECT s.model, yd.threshold, count(*) FILTER (WHERE s.proba >= yd.threshold) AS n_positive FROM scores s JOIN yd USING (model)
GROUP BY s.model, yd.threshold""")
def q_a5(spark, sf):
    s = scores(spark, sf)
    params = youden_threshold(s, "proba", "label", "model").select("model", "threshold")
    path = scratch_path(spark, "params")
    params.coalesce(1).select(F.to_json(F.collect_list(F.struct("model", "threshold"))).alias("j")) \
        .write.text(path)
    back = read_json(spark, path, "model string, threshold double", multiline=True)
    j = s.join(checked_broadcast(back), "model")
    return j.groupBy("model", "threshold").agg(F.count(F.when(F.col("proba") >= F.col("threshold"), 1)).alias("n_positive"))


@query("q_a5_json_params_fit")
def q_a5_fit(spark, sf):
    """The best setting of each kind is written as JSON, read again and refitted: the score must come back."""
    from tabforge.operators.models import ModelSpec
    from tabforge.plans.recipes import MODEL_FEATURES, model_frame
    from tabforge.training.fits import cv_table
    t = model_frame(spark, sf).where("origin = 'train'")
    tried = ([ModelSpec(f"linear_{c}", "logreg", {"C": c, "max_iter": 1000}) for c in (0.01, 0.1, 1.0)]
             + [ModelSpec(f"forest_{d}", "forest", {"n_trees": 50, "max_depth": d, "max_features": "sqrt"}) for d in (3, 6)])
    scores_of = {r["model"]: r["cv_score"] for r in cv_table(t, tried, {"all": MODEL_FEATURES}, with_train=False).collect()}  # one row a model
    best = [max((s for s in tried if s.kind == kind), key=lambda s: (scores_of[s.name], s.name)) for kind in ("logreg", "forest")]
    path = scratch_path(spark, "best_params")
    spark.createDataFrame([(json.dumps([{"model": s.name, "kind": s.kind, "params": s.params, "score": scores_of[s.name]} for s in best]),)],
                          "j string").coalesce(1).write.text(path)
    back = read_model_params(spark, path)
    refit = cv_table(t, [ModelSpec(r["model"], r["kind"], r["params"]) for r in back], {"all": MODEL_FEATURES}, with_train=False)
    stated = spark.createDataFrame([(r["model"], float(r["score"])) for r in back], "model string, stated_score double")
    return refit.join(F.broadcast(stated), "model").select("model", F.round("stated_score", 6).alias("stated_score"),
                                                           F.round("cv_score", 6).alias("cv_score"), F.round("oof_score", 6).alias("oof_score"))


@query("q_a6_run_record_append", """
SELECT 'run1' AS run, klass, count(*) AS n FROM base GROUP BY klass
UNION ALL SELECT 'run2', klass, CAST(sum(label) AS BIGINT) FROM base GROUP BY klass""")
def q_a6(spark, sf):
    b = base(spark, sf)
    path = scratch_path(spark, "runs")
    append_run_record(b.groupBy("klass").agg(F.count(F.lit(1)).alias("n")), path, "run1")
    append_run_record(b.groupBy("klass").agg(F.sum("label").cast("long").alias("n")), path, "run2")
    return spark.read.parquet(path).select("run", "klass", "n")
