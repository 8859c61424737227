"""Encoding and feature construction (I*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.functions.text import concat_keys, prefix_class
from tabforge.operators.common import flag
from tabforge.operators.encode import (family_features, gated, label_encoder, one_hot, one_hot_fixed,
                                       rare_bucket, sparse_one_hot, standard_scaler, target_mean_oof)
from tabforge.operators.folds import stratified_folds
from tabforge.operators.joins import count_lookup, dict_lookup
from tabforge.operators.features import long_features
from tabforge.plans.fixtures import base
from tabforge.plans.q_groups import PREFIX_SQL
from tabforge.plans.q_relational import FOLD_SQL, TITLE_SQL, is_train
from tabforge.plans.recipes import coded_recipe, wide_recipe
from tabforge.plans.registry import query


@query("q_i1_label_encode", """
WITH c AS (SELECT klass, CAST(row_number() OVER (ORDER BY klass) - 1 AS INTEGER) AS klass_code
           FROM (SELECT DISTINCT klass FROM base WHERE origin = 'train' AND klass IS NOT NULL))
SELECT id, klass_code FROM base LEFT JOIN c USING (klass)""")
def q_i1(spark, sf):
    b = base(spark, sf)
    return label_encoder(b.where(is_train()), "klass").transform(b).select("id", "klass_code")


# Ordinal codes of the priority class, unmapped -> 4.
PRIORITY_ORDINAL = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}


@query("q_i2_ordinal_map_default", """
SELECT id, coalesce(CASE klass WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END, 4) AS priority FROM base""")
def q_i2(spark, sf):
    return dict_lookup(base(spark, sf), "klass", PRIORITY_ORDINAL, "priority", default=4).select("id", "priority")


@query("q_i3_one_hot_drop_first", """
SELECT id, CAST(coalesce(region = 'AMERICA', false) AS INTEGER) AS "region_AMERICA",
       CAST(coalesce(region = 'ASIA', false) AS INTEGER) AS "region_ASIA",
       CAST(coalesce(region = 'EUROPE', false) AS INTEGER) AS "region_EUROPE",
       CAST(coalesce(region = 'MIDDLE EAST', false) AS INTEGER) AS "region_MIDDLE EAST" FROM base""")
def q_i3(spark, sf):
    b = base(spark, sf)
    m = one_hot(b.where(is_train()), "region")
    return m.transform(b).select("id", *m.columns)


@query("q_i3_one_hot_sparse", """
WITH c AS (SELECT ticket, row_number() OVER (ORDER BY ticket) - 2 AS slot FROM (SELECT DISTINCT ticket FROM base WHERE origin = 'train' AND ticket IS NOT NULL))
SELECT id, CAST(slot AS INTEGER) AS slot, (SELECT count(*) - 1 FROM c) AS n_slots FROM base JOIN c USING (ticket) WHERE slot >= 0""")
def q_i3_sparse(spark, sf):
    b = base(spark, sf)
    m = sparse_one_hot(b.where(is_train()), "ticket")
    return m.long(b, "id").select("id", "slot", F.lit(m.n_slots).cast("long").alias("n_slots"))


@query("q_i4_one_hot_fixed_list", """
SELECT id, CAST(category = 'F' AS INTEGER) AS cat_F, CAST(category = 'O' AS INTEGER) AS cat_O,
       CAST(category = 'P' AS INTEGER) AS cat_P FROM base""")
def q_i4(spark, sf):
    return base(spark, sf).withColumns(one_hot_fixed("category", ["F", "O", "P"], "cat")).select(
        "id", "cat_F", "cat_O", "cat_P")


@query("q_i5_rare_category_bucket", """
WITH c AS (SELECT unit_code, count(*) AS n FROM base WHERE unit_code IS NOT NULL GROUP BY unit_code)
SELECT id, CASE WHEN unit_code IS NULL THEN 'Unknown' WHEN coalesce(c.n, 0) < 10 THEN 'Other' ELSE unit_code END AS unit
FROM base LEFT JOIN c USING (unit_code)""")
def q_i5(spark, sf):
    return rare_bucket(base(spark, sf), "unit_code", 10, "unit").select("id", "unit")


@query("q_i6_family_features", """
SELECT id, n_sib + n_par + 1 AS family_size, CAST(n_sib + n_par + 1 = 1 AS INTEGER) AS is_alone,
       CAST(n_sib + n_par + 1 BETWEEN 2 AND 4 AS INTEGER) AS small_family FROM base""")
def q_i6(spark, sf):
    return base(spark, sf).withColumns(family_features("n_sib", "n_par")).select(
        "id", "family_size", "is_alone", "small_family")


@query("q_i7_group_size_features", """
SELECT id, count(*) OVER (PARTITION BY ticket) AS ticket_size, CAST(count(*) OVER (PARTITION BY ticket) > 1 AS INTEGER) AS shared,
       CAST(count(*) OVER (PARTITION BY ticket) BETWEEN 2 AND 4 AS INTEGER) AS optimal FROM base""")
def q_i7(spark, sf):
    b = count_lookup(base(spark, sf), "ticket", "ticket_size")
    return b.select("id", "ticket_size", flag(F.col("ticket_size") > 1).alias("shared"),
                    flag(F.col("ticket_size").between(2, 4)).alias("optimal"))


@query("q_i8_per_member_amount", """
SELECT id, round(amount_b / count(*) OVER (PARTITION BY ticket), 6) AS amount_per_member,
       round(amount_b / (n_sib + n_par + 1), 6) AS amount_per_family FROM base""")
def q_i8(spark, sf):
    b = count_lookup(base(spark, sf), "ticket", "_size")
    return b.select("id", F.round(F.col("amount_b") / F.col("_size"), 6).alias("amount_per_member"),
                    F.round(F.col("amount_b") / (F.col("n_sib") + F.col("n_par") + 1), 6).alias("amount_per_family"))


# Prefix classes of two bands, chosen for these tables.
HIGH_PREFIXES = ["PC", "SOTON_O_Q"]
LOW_PREFIXES = ["A", "W_C"]


@query("q_i9_key_prefix_category", f"""
SELECT id, CASE WHEN {PREFIX_SQL} IN ('PC', 'SOTON_O_Q') THEN 'high' WHEN {PREFIX_SQL} IN ('A', 'W_C') THEN 'low'
  ELSE 'medium' END AS prefix_band FROM base""")
def q_i9(spark, sf):
    p = prefix_class("ticket")
    band = F.when(p.isin(HIGH_PREFIXES), "high").when(p.isin(LOW_PREFIXES), "low").otherwise("medium")
    return base(spark, sf).select("id", band.alias("prefix_band"))


@query("q_i10_target_mean_out_of_fold", f"""
WITH t AS (SELECT id, label, {PREFIX_SQL} AS prefix, {FOLD_SQL} AS fold FROM base),
pf AS (SELECT prefix, fold, sum(label) AS sf, count(*) AS nf FROM t GROUP BY prefix, fold),
pt AS (SELECT prefix, sum(sf) AS s, sum(nf) AS n FROM pf GROUP BY prefix),
ft AS (SELECT fold, sum(label) AS fs, count(*) AS fn FROM t GROUP BY fold),
a AS (SELECT sum(label) AS s_all, count(*) AS n_all FROM t)
SELECT t.id, round(coalesce(CASE WHEN pt.n - pf.nf > 0 THEN CAST(pt.s - pf.sf AS DOUBLE) / (pt.n - pf.nf) END,
                            CAST(a.s_all - ft.fs AS DOUBLE) / (a.n_all - ft.fn)), 6) AS target_mean
FROM t JOIN pf USING (prefix, fold) JOIN pt USING (prefix) JOIN ft USING (fold) CROSS JOIN a""")
def q_i10(spark, sf):
    b = base(spark, sf).select("id", "label", prefix_class("ticket").alias("prefix"))
    # the fold assignment is a shuffle; both passes of the encoder reuse it
    f = stratified_folds(b, "id", "label").persist()
    out = target_mean_oof(f, "prefix", "label", "fold")
    return out.select("id", F.round("target_mean", 6).alias("target_mean"))


@query("q_i11_string_cross_encode", """
WITH t AS (SELECT *, klass || '_' || category AS cross_key FROM base),
c AS (SELECT cross_key, CAST(row_number() OVER (ORDER BY cross_key) - 1 AS INTEGER) AS cross_code
      FROM (SELECT DISTINCT cross_key FROM t WHERE origin = 'train'))
SELECT id, cross_key, cross_code FROM t LEFT JOIN c USING (cross_key)""")
def q_i11(spark, sf):
    b = base(spark, sf).withColumn("cross_key", concat_keys("klass", "category"))
    return label_encoder(b.where(is_train()), "cross_key", "cross_code").transform(b).select("id", "cross_key", "cross_code")


@query("q_i12_product_ratio", """
SELECT id, round(amount_a * n_sib, 6) + CAST(0 AS DOUBLE) AS a_x_sib, round(amount_b / (n_par + 1), 6) AS b_per_par,
       CAST(label * (n_sib + 1) AS INTEGER) AS label_x_sib FROM base""")
def q_i12(spark, sf):
    return base(spark, sf).select("id", (F.round(F.col("amount_a") * F.col("n_sib"), 6) + F.lit(0.0)).alias("a_x_sib"),
                                  F.round(F.col("amount_b") / (F.col("n_par") + 1), 6).alias("b_per_par"),
                                  (F.col("label") * (F.col("n_sib") + 1)).cast("int").alias("label_x_sib"))


@query("q_i13_gated_interaction", """
SELECT id, CASE WHEN category = 'F' THEN amount_a ELSE 0 END AS a_if_f,
       CASE WHEN category = 'O' THEN n_sib ELSE 0 END AS sib_if_o FROM base""")
def q_i13(spark, sf):
    return base(spark, sf).select("id", gated(F.col("amount_a"), "category", "F").cast("double").alias("a_if_f"),
                                  gated("n_sib", "category", "O").alias("sib_if_o"))


@query("q_i14_crossed_one_hot", "SELECT id, " + ", ".join(
    f"CAST(coalesce(category || '_' || klass = '{c}_{k}', false) AS INTEGER) AS \"ck_{c}_{k}\""
    for c in ["F", "O", "P"] for k in ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    if (c, k) != ("F", "1-URGENT")) + " FROM base")
def q_i14(spark, sf):
    b = base(spark, sf).withColumn("ck", concat_keys("category", "klass"))
    m = one_hot(b.where(is_train()), "ck")
    return m.transform(b).select("id", *m.columns)


@query("q_i14_crossed_one_hot_sparse", """
WITH t AS (SELECT *, ticket || '_' || klass AS ck FROM base),
c AS (SELECT ck, row_number() OVER (ORDER BY ck) - 2 AS slot FROM (SELECT DISTINCT ck FROM t WHERE origin = 'train' AND ck IS NOT NULL))
SELECT id, ck, CAST(CASE WHEN slot >= 0 THEN slot END AS INTEGER) AS slot FROM t LEFT JOIN c USING (ck)""")
def q_i14_sparse(spark, sf):
    b = base(spark, sf).withColumn("ck", concat_keys("ticket", "klass"))
    return sparse_one_hot(b.where(is_train()), "ck").transform(b, "slot").select("id", "ck", "slot")


@query("q_i15_standardise_population", """
WITH s AS (SELECT avg(amount_a) AS ma, stddev_pop(amount_a) AS sa, avg(amount_b) AS mb, stddev_pop(amount_b) AS sb
           FROM base WHERE origin = 'train')
SELECT id, round((amount_a - ma) / sa, 6) AS amount_a_z, round((amount_b - mb) / sb, 6) AS amount_b_z FROM base CROSS JOIN s""")
def q_i15(spark, sf):
    b = base(spark, sf)
    m = standard_scaler(b.where(is_train()), ["amount_a", "amount_b"], "_z")
    return m.transform(b).select("id", F.round("amount_a_z", 6).alias("amount_a_z"),
                                 F.round("amount_b_z", 6).alias("amount_b_z"))


@query("q_i16_composite_feature_recipe", f"""
WITH t AS (SELECT *, {TITLE_SQL} AS title FROM base),
r2 AS (SELECT klass, title, median(amount_a) AS v2 FROM t WHERE origin = 'train' AND title IS NOT NULL GROUP BY klass, title),
r0 AS (SELECT median(amount_a) AS v0 FROM t WHERE origin = 'train'),
f AS (SELECT t.*, coalesce(t.amount_a, r2.v2, r0.v0) AS amount_f FROM t LEFT JOIN r2 ON t.klass = r2.klass AND t.title = r2.title CROSS JOIN r0)
SELECT id, amount_f AS amount_a, n_sib + n_par + 1 AS family_size, CAST(n_sib + n_par + 1 = 1 AS INTEGER) AS is_alone,
       CAST(category = 'O' AS INTEGER) AS cat_O, CAST(category = 'P' AS INTEGER) AS cat_P,
       CAST(unit_code IS NOT NULL AS INTEGER) AS has_unit, CASE title WHEN 'Mr' THEN 0 WHEN 'Miss' THEN 1 WHEN 'Mrs' THEN 2
       WHEN 'Master' THEN 3 ELSE 4 END AS title_code, label FROM f""")
def q_i16(spark, sf):
    from tabforge.plans.recipes import basic_recipe
    return basic_recipe(base(spark, sf))


_MERGED_SQL = f"""CASE WHEN {TITLE_SQL} IN ('Lady', 'Countess', 'Capt', 'Col', 'Don', 'Dr', 'Major', 'Rev', 'Sir', 'Jonkheer', 'Dona') THEN 'Rare'
  WHEN {TITLE_SQL} IN ('Mlle', 'Ms') THEN 'Miss' WHEN {TITLE_SQL} = 'Mme' THEN 'Mrs' ELSE {TITLE_SQL} END"""
_CODED_SQL = f"""
WITH t AS (SELECT *, CASE {_MERGED_SQL} WHEN 'Mr' THEN 1 WHEN 'Miss' THEN 2 WHEN 'Mrs' THEN 3 WHEN 'Master' THEN 4 WHEN 'Rare' THEN 5 ELSE 0 END AS title_code,
             CAST(substr(klass, 1, 1) AS INTEGER) AS klass_num, count(*) OVER (PARTITION BY ticket) AS ticket_group FROM base),
g AS (SELECT title_code, klass, median(amount_a) AS v FROM t GROUP BY title_code, klass),
k AS (SELECT klass, median(amount_b) AS w FROM t GROUP BY klass),
f AS (SELECT t.* REPLACE (coalesce(amount_a, v) AS amount_a, coalesce(amount_b, w) AS amount_b), CAST(amount_a IS NULL AS INTEGER) AS amount_a_missing,
        CAST(region IS NULL AS INTEGER) AS region_missing FROM t LEFT JOIN g USING (title_code, klass) LEFT JOIN k USING (klass)),
m AS (SELECT median(amount_a) AS rest, list_sort(list_distinct(quantile_cont(amount_b, [0, 0.25, 0.5, 0.75, 1.0]))) AS e FROM f)
SELECT id, klass_num, CASE category WHEN 'O' THEN 0 WHEN 'F' THEN 1 WHEN 'P' THEN 2 END AS category_code, title_code, coalesce(amount_a, rest) AS amount_a,
  CAST(n_sib + n_par = 0 AS INTEGER) AS is_alone, CASE WHEN amount_b = e[1] THEN 0 ELSE CAST(len(list_filter(e, lambda x: x < amount_b)) - 1 AS INTEGER) END AS amount_bin,
  CAST(n_sib + n_par BETWEEN 1 AND 3 AS INTEGER) AS small_family, amount_a_missing, region_missing, label"""
_DECK_SQL = "CAST(coalesce(substr(unit_code, 1, 1) IN ('D', 'E', 'B'), false) AS INTEGER) AS deck_safe"


@query("q_i16_recipe_9_columns", _CODED_SQL + " FROM f CROSS JOIN m")
def q_i16_9(spark, sf):
    return coded_recipe(base(spark, sf), 9)


@query("q_i16_recipe_10_columns", f"{_CODED_SQL}, {_DECK_SQL} FROM f CROSS JOIN m")
def q_i16_10(spark, sf):
    return coded_recipe(base(spark, sf), 10)


@query("q_i16_recipe_11_columns", f"{_CODED_SQL}, {_DECK_SQL}, ticket_group FROM f CROSS JOIN m")
def q_i16_11(spark, sf):
    return coded_recipe(base(spark, sf), 11)


@query("q_i16_recipe_20_columns", f"""
WITH t AS (SELECT *, CASE WHEN {_MERGED_SQL} IN ('Mr', 'Miss', 'Mrs', 'Master') THEN {_MERGED_SQL} ELSE 'Rare' END AS title,
             CAST(substr(klass, 1, 1) AS INTEGER) AS klass_num, n_sib + n_par + 1 AS family_size, count(*) OVER (PARTITION BY ticket) AS ticket_group FROM base),
g AS (SELECT title, median(amount_a) AS v FROM t GROUP BY title), m AS (SELECT median(amount_b) AS w FROM t),
f AS (SELECT t.* REPLACE (coalesce(amount_a, v) AS amount_a, CASE WHEN amount_b = 0 THEN w ELSE coalesce(amount_b, w) END AS amount_b,
             coalesce(region, 'ASIA') AS region) FROM t JOIN g USING (title) CROSS JOIN m)
SELECT id, klass_num, CAST(category = 'O' AS INTEGER) AS is_first_category, amount_a, n_sib, n_par, family_size, CAST(family_size = 1 AS INTEGER) AS is_alone,
  amount_b, {", ".join(f"CAST(region = '{r}' AS INTEGER) AS region_{r}" for r in ["AFRICA", "AMERICA", "ASIA"])},
  {", ".join(f"CAST(title = '{t}' AS INTEGER) AS title_{t}" for t in ["Mr", "Miss", "Mrs", "Master", "Rare"])},
  amount_b / family_size AS amount_per_person, ticket_group, amount_a * klass_num AS amount_a_x_klass, amount_b / klass_num AS amount_b_per_klass, label FROM f""")
def q_i16_20(spark, sf):
    return wide_recipe(base(spark, sf))


# Per-model feature lists of the selection demo.
MODEL_FEATURES = {"linear": ["amount_a", "n_sib"], "tree": ["amount_b", "n_par", "n_sib"]}


@query("q_i17_per_model_features", " UNION ALL ".join(
    f"SELECT id, '{m}' AS model, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM base"
    for m, cs in MODEL_FEATURES.items() for c in cs))
def q_i17(spark, sf):
    return long_features(base(spark, sf), "id", MODEL_FEATURES)
