"""Flagship query: impute -> quantile-bin -> group rate table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.functions.bins import qcut, quantile_edges
from tabforge.functions.text import title
from tabforge.operators.groups import group_rate
from tabforge.operators.impute import GroupImputer
from tabforge.plans.fixtures import base
from tabforge.plans.registry import query

FLAGSHIP_SQL = r"""
WITH t AS (SELECT *, nullif(regexp_extract(full_name, ' ([A-Za-z]+)\.', 1), '') AS title FROM base),
r2 AS (SELECT klass, title, median(amount_a) AS v2 FROM t WHERE origin = 'train' AND title IS NOT NULL GROUP BY klass, title),
r1 AS (SELECT klass, median(amount_a) AS v1 FROM t WHERE origin = 'train' GROUP BY klass),
r0 AS (SELECT median(amount_a) AS v0 FROM t WHERE origin = 'train'),
f AS (SELECT t.*, coalesce(t.amount_a, r2.v2, r1.v1, r0.v0) AS amount_f
      FROM t LEFT JOIN r2 ON t.klass = r2.klass AND t.title = r2.title LEFT JOIN r1 ON t.klass = r1.klass CROSS JOIN r0),
e AS (SELECT list_sort(list_distinct(quantile_cont(amount_f, [0, 0.25, 0.5, 0.75, 1.0]))) AS q FROM f WHERE origin = 'train'),
b AS (SELECT f.*, CASE WHEN amount_f IS NULL OR amount_f < e.q[1] OR amount_f > e.q[len(e.q)] THEN NULL
                      WHEN amount_f = e.q[1] THEN 0
                      ELSE CAST(len(list_filter(e.q, lambda x: x < amount_f)) - 1 AS INTEGER) END AS amount_bin
      FROM f CROSS JOIN e)
SELECT amount_bin, category, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives,
       round_even(avg(CAST(label AS DOUBLE)), 6) AS rate
FROM b WHERE amount_bin IS NOT NULL GROUP BY amount_bin, category
"""


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = base(spark, sf_dir).withColumn("title", title("full_name"))
    train = b.where(F.col("origin") == "train")
    model = GroupImputer("amount_a", [["klass", "title"], ["klass"]], stat="median").fit(train)
    filled = model.transform(b)
    edges = quantile_edges(filled.where(F.col("origin") == "train"), "amount_a", 4)
    binned = filled.withColumn("amount_bin", qcut("amount_a", edges))
    return group_rate(binned, ["amount_bin", "category"], "label")


query("q_flagship_impute_bin_rate", FLAGSHIP_SQL)(flagship)
