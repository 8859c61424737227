"""Exact k-nearest-neighbour imputation (oracle: brute force in SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.operators.joins import dict_lookup, with_scalars
from tabforge.operators.knn import knn_impute
from tabforge.operators.knn_masked import knn_impute_masked
from tabforge.operators.quantiles import group_median
from tabforge.plans.fixtures import base
from tabforge.plans.registry import query
from tabforge.session import cut_lineage

KNN_FEATURES = ["klass_num", "n_sib", "n_par", "amount_bf"]


@query("q_j18_knn_imputation", """
WITH m AS (SELECT median(amount_b) AS med FROM base WHERE origin = 'train'),
x AS (SELECT id, origin, amount_a, CAST(substr(klass, 1, 1) AS INTEGER) AS klass_num, n_sib, n_par,
             coalesce(amount_b, med) AS amount_bf FROM base CROSS JOIN m),
d AS (SELECT * FROM x WHERE origin = 'train' AND amount_a IS NOT NULL),
p AS (SELECT * FROM x WHERE amount_a IS NULL),
pr AS (SELECT p.id, d.amount_a AS t, row_number() OVER (PARTITION BY p.id ORDER BY
         pow(CAST(p.klass_num AS DOUBLE) - CAST(d.klass_num AS DOUBLE), 2) + pow(CAST(p.n_sib AS DOUBLE) - CAST(d.n_sib AS DOUBLE), 2)
       + pow(CAST(p.n_par AS DOUBLE) - CAST(d.n_par AS DOUBLE), 2) + pow(p.amount_bf - d.amount_bf, 2), d.id) AS rn
       FROM p CROSS JOIN d)
SELECT id, round(avg(t), 6) AS amount_a FROM pr WHERE rn <= 5 GROUP BY id""")
def q_j18(spark, sf):
    b = base(spark, sf)
    med = group_median(b.where(F.col("origin") == "train"), "amount_b", None, "_med")
    x = with_scalars(b, med).select("id", "origin", "amount_a", F.substring("klass", 1, 1).cast("int").alias("klass_num"),
                                    "n_sib", "n_par", F.coalesce("amount_b", "_med").alias("amount_bf"))
    filled = knn_impute(x, x.where(F.col("origin") == "train"), "id", "amount_a", KNN_FEATURES, k=5)
    return filled.join(x.where(F.col("amount_a").isNull()).select("id"), "id", "left_semi").select(
        "id", F.round("amount_a", 6).alias("amount_a"))


# Codes of the nullable and the three-valued category.
REGION_CODES = {"AFRICA": 0, "AMERICA": 1, "ASIA": 2, "EUROPE": 3, "MIDDLE EAST": 4}
CATEGORY_CODES = {"O": 0, "F": 1, "P": 2}
MASKED_FEATURES = ["klass_num", "category_code", "amount_a", "n_sib", "n_par", "amount_b", "region_code"]


def _masked_sql(target):
    shared = " + ".join(f"CAST(p.{c} IS NOT NULL AND d.{c} IS NOT NULL AS INTEGER)" for c in MASKED_FEATURES)
    d2 = " + ".join(f"coalesce(pow(CAST(p.{c} AS DOUBLE) - CAST(d.{c} AS DOUBLE), 2), 0)" for c in MASKED_FEATURES)
    return f"""{target}_fill AS (SELECT id, avg(t) AS v FROM (
  SELECT p.id, CAST(d.{target} AS DOUBLE) AS t, row_number() OVER (PARTITION BY p.id ORDER BY ({d2}) * (CAST({len(MASKED_FEATURES)} AS DOUBLE) / ({shared})), d.id) AS rn
  FROM x p CROSS JOIN x d WHERE p.{target} IS NULL AND d.origin = 'train' AND d.{target} IS NOT NULL) WHERE rn <= 5 GROUP BY id)"""


@query("q_j18_knn_nan_aware", f"""
WITH x AS (SELECT id, origin, CAST(substr(klass, 1, 1) AS INTEGER) AS klass_num, CASE category WHEN 'O' THEN 0 WHEN 'F' THEN 1 WHEN 'P' THEN 2 END AS category_code,
  amount_a, n_sib, n_par, amount_b, CASE region WHEN 'AFRICA' THEN 0 WHEN 'AMERICA' THEN 1 WHEN 'ASIA' THEN 2 WHEN 'EUROPE' THEN 3 WHEN 'MIDDLE EAST' THEN 4 END AS region_code
  FROM base), {", ".join(_masked_sql(t) for t in ["amount_a", "amount_b", "region_code"])}
SELECT id, round(coalesce(amount_a, a.v), 6) AS amount_a, round(coalesce(amount_b, b.v), 6) AS amount_b, round(coalesce(CAST(region_code AS DOUBLE), r.v), 6) AS region_code
FROM x LEFT JOIN amount_a_fill a USING (id) LEFT JOIN amount_b_fill b USING (id) LEFT JOIN region_code_fill r USING (id)""")
def q_j18_masked(spark, sf):
    x = base(spark, sf).withColumn("klass_num", F.substring("klass", 1, 1).cast("int"))
    x = dict_lookup(dict_lookup(x, "category", CATEGORY_CODES, "category_code"), "region", REGION_CODES, "region_code")
    x = cut_lineage(x.select("id", "origin", *MASKED_FEATURES))  # every step of the search reads it
    filled = knn_impute_masked(x, x.where("origin = 'train'"), "id", MASKED_FEATURES)
    return filled.select("id", *[F.round(c, 6).alias(c) for c in ("amount_a", "amount_b", "region_code")])
