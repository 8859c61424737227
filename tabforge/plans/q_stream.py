"""Streaming by-product: the fitted rule imputer applied to a file stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.functions.text import title
from tabforge.operators.impute import GroupImputer
from tabforge.plans.fixtures import base
from tabforge.plans.q_relational import TITLE_SQL
from tabforge.plans.registry import query
from tabforge.sources.files import scratch_path
from tabforge.streaming import run_available


@query("q_stream_fitted_imputer", f"""
WITH t AS (SELECT *, {TITLE_SQL} AS title FROM base),
r2 AS (SELECT klass, title, median(amount_a) AS v2 FROM t WHERE origin = 'train' AND title IS NOT NULL GROUP BY klass, title),
r1 AS (SELECT klass, median(amount_a) AS v1 FROM t WHERE origin = 'train' GROUP BY klass),
r0 AS (SELECT median(amount_a) AS v0 FROM t WHERE origin = 'train')
SELECT id, coalesce(t.amount_a, r2.v2, r1.v1, r0.v0) AS amount_a FROM t
LEFT JOIN r2 ON t.klass = r2.klass AND t.title = r2.title LEFT JOIN r1 ON t.klass = r1.klass CROSS JOIN r0
WHERE origin = 'serve'""")
def q_stream(spark, sf):
    b = base(spark, sf).withColumn("title", title("full_name"))
    model = GroupImputer("amount_a", [["klass", "title"], ["klass"]]).fit(b.where(F.col("origin") == "train"))
    landing = scratch_path(spark, "landing")
    serve = b.where(F.col("origin") == "serve").select("id", "klass", "title", "amount_a")
    serve.write.parquet(landing)
    out = run_available(spark, landing, serve.schema, lambda s: model.transform(s).select("id", "amount_a"),
                        scratch_path(spark, "stream-out"))
    return spark.read.parquet(out)
