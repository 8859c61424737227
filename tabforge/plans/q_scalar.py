"""Scalar column functions (H*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.functions.bins import bucket, category_codes, cut, labelled, qcut, quantile_edges
from tabforge.functions.numeric import percent_text, safe_ratio
from tabforge.functions.text import (concat_keys, first_char, first_int, prefix_class, replace_values,
                                     str_len, title)
from tabforge.plans.fixtures import base
from tabforge.plans.q_groups import PREFIX_SQL
from tabforge.plans.q_relational import TITLE_SQL, is_train
from tabforge.plans.registry import query

def age():
    return F.col("amount_a") / F.lit(100.0)


AGE_SQL = "(amount_a / 100.0)"


@query("q_h1_regex_extract", f"SELECT id, {TITLE_SQL} AS title FROM base")
def q_h1(spark, sf):
    return base(spark, sf).select("id", title("full_name").alias("title"))


@query("q_h2_first_char", "SELECT id, coalesce(substr(unit_code, 1, 1), 'Unknown') AS deck FROM base")
def q_h2(spark, sf):
    return base(spark, sf).select("id", first_char("unit_code", "Unknown").alias("deck"))


@query("q_h3_string_length", "SELECT id, CAST(length(full_name) AS INTEGER) AS name_len FROM base")
def q_h3(spark, sf):
    return base(spark, sf).select("id", str_len("full_name").alias("name_len"))


@query("q_h4_prefix_normaliser", f"SELECT id, {PREFIX_SQL} AS prefix FROM base")
def q_h4(spark, sf):
    return base(spark, sf).select("id", prefix_class("ticket").alias("prefix"))


@query("q_h5_first_integer", """
SELECT id, coalesce(CAST(nullif(regexp_extract(ticket, '(\\d+)', 1), '') AS BIGINT), 0) AS ticket_number FROM base""")
def q_h5(spark, sf):
    return base(spark, sf).select("id", first_int("ticket").alias("ticket_number"))


# Titles folded into one rare class.
RARE_TITLES = ["Dr", "Countess", "Mlle"]


@query("q_h6_value_list_replace", f"""
SELECT id, CASE WHEN {TITLE_SQL} IN ('Dr', 'Countess', 'Mlle') THEN 'Rare' ELSE {TITLE_SQL} END AS title FROM base""")
def q_h6(spark, sf):
    return base(spark, sf).select("id", replace_values(title("full_name"), RARE_TITLES, "Rare").alias("title"))


@query("q_h7_concat_keys", "SELECT id, klass || '_' || region AS klass_region FROM base")
def q_h7(spark, sf):
    return base(spark, sf).select("id", concat_keys("klass", "region").alias("klass_region"))


@query("q_h8_string_methods", """
SELECT id, lower(category) AS cat_lower, replace(ticket, '/', '') AS ticket_clean,
       CAST(starts_with(ticket, 'PC') AS INTEGER) AS is_pc, CAST(contains(full_name, 'Mr.') AS INTEGER) AS has_mr,
       split_part(full_name, ',', 1) AS surname, trim(' ' || klass || ' ') AS klass_trim,
       CAST(strpos(full_name, ',') AS INTEGER) AS comma_pos FROM base""")
def q_h8(spark, sf):
    return base(spark, sf).select(
        "id", F.lower("category").alias("cat_lower"), F.replace(F.col("ticket"), F.lit("/"), F.lit("")).alias("ticket_clean"),
        F.col("ticket").startswith("PC").cast("int").alias("is_pc"),
        F.col("full_name").contains("Mr.").cast("int").alias("has_mr"),
        F.split_part(F.col("full_name"), F.lit(","), F.lit(1)).alias("surname"),
        F.trim(F.concat(F.lit(" "), F.col("klass"), F.lit(" "))).alias("klass_trim"),
        F.instr(F.col("full_name"), ",").alias("comma_pos"))


@query("q_h9_percent_format", """
WITH g AS (SELECT category, CAST(sum(label) AS BIGINT) AS pos, count(*) AS n FROM base GROUP BY category)
SELECT category, CAST((2000 * pos + n) // (2 * n) // 10 AS VARCHAR) || '.' || CAST((2000 * pos + n) // (2 * n) % 10 AS VARCHAR) || '%' AS pct
FROM g""")
def q_h9(spark, sf):
    g = base(spark, sf).groupBy("category").agg(F.sum("label").cast("long").alias("pos"), F.count(F.lit(1)).alias("n"))
    return g.select("category", percent_text("pos", "n", 1).alias("pct"))


@query("q_h10_arithmetic", """
SELECT id, n_sib + n_par + 1 AS family, n_sib * n_par AS prod, round(amount_b / (n_sib + n_par + 1), 6) AS ratio,
       abs(amount_a) AS abs_a, round(amount_b - amount_a, 6) AS diff FROM base""")
def q_h10(spark, sf):
    fam = F.col("n_sib") + F.col("n_par") + 1
    return base(spark, sf).select("id", fam.alias("family"), (F.col("n_sib") * F.col("n_par")).alias("prod"),
                                  F.round(F.col("amount_b") / fam, 6).alias("ratio"), F.abs("amount_a").alias("abs_a"),
                                  F.round(F.col("amount_b") - F.col("amount_a"), 6).alias("diff"))


@query("q_h11_half_even_round", """
SELECT group_key, CAST(round_even(avg(CAST(label AS DOUBLE)), 0) AS INTEGER) AS vote FROM base GROUP BY group_key""")
def q_h11(spark, sf):
    return base(spark, sf).groupBy("group_key").agg(
        F.bround(F.avg(F.col("label").cast("double")), 0).cast("int").alias("vote"))


@query("q_h12_cut_right_closed", f"""
SELECT id, CASE WHEN {AGE_SQL} > 0 AND {AGE_SQL} <= 12 THEN 0 WHEN {AGE_SQL} > 12 AND {AGE_SQL} <= 18 THEN 1
  WHEN {AGE_SQL} > 18 AND {AGE_SQL} <= 40 THEN 2 WHEN {AGE_SQL} > 40 AND {AGE_SQL} <= 100 THEN 3 END AS age_bin FROM base""")
def q_h12(spark, sf):
    return base(spark, sf).select("id", cut(age(), [0, 12, 18, 40, 100]).alias("age_bin"))


@query("q_h13_cut_left_closed", f"""
SELECT id, CASE WHEN {AGE_SQL} >= 0 AND {AGE_SQL} < 18 THEN 'young' WHEN {AGE_SQL} >= 18 AND {AGE_SQL} < 60 THEN 'adult'
  WHEN {AGE_SQL} >= 60 AND {AGE_SQL} < 80 THEN 'senior' END AS age_group FROM base""")
def q_h13(spark, sf):
    return base(spark, sf).select("id", labelled(cut(age(), [0, 18, 60, 80], right=False),
                                                 ["young", "adult", "senior"]).alias("age_group"))


@query("q_h14_cut_include_lowest", """
SELECT id, CASE WHEN n_sib + n_par + 1 >= 1 AND n_sib + n_par + 1 <= 1 THEN 0 WHEN n_sib + n_par + 1 > 1 AND n_sib + n_par + 1 <= 4 THEN 1
  WHEN n_sib + n_par + 1 > 4 AND n_sib + n_par + 1 <= 11 THEN 2 END AS family_bin FROM base""")
def q_h14(spark, sf):
    fam = F.col("n_sib") + F.col("n_par") + 1
    return base(spark, sf).select("id", cut(fam, [1, 1, 4, 11], include_lowest=True).alias("family_bin"))


@query("q_h15_category_codes", f"""
SELECT id, coalesce(CASE WHEN {AGE_SQL} > 0 AND {AGE_SQL} <= 12 THEN 0 WHEN {AGE_SQL} > 12 AND {AGE_SQL} <= 18 THEN 1
  WHEN {AGE_SQL} > 18 AND {AGE_SQL} <= 40 THEN 2 WHEN {AGE_SQL} > 40 AND {AGE_SQL} <= 100 THEN 3 END, -1) AS age_code FROM base""")
def q_h15(spark, sf):
    return base(spark, sf).select("id", category_codes(cut(age(), [0, 12, 18, 40, 100])).alias("age_code"))


@query("q_h16_quantile_bins", """
WITH e AS (SELECT list_sort(list_distinct(quantile_cont(amount_b, [0, 0.25, 0.5, 0.75, 1.0]))) AS q FROM base WHERE origin = 'train')
SELECT id, CASE WHEN amount_b IS NULL OR amount_b < q[1] OR amount_b > q[len(q)] THEN NULL WHEN amount_b = q[1] THEN 0
  ELSE CAST(len(list_filter(q, lambda x: x < amount_b)) - 1 AS INTEGER) END AS amount_q FROM base CROSS JOIN e""")
def q_h16(spark, sf):
    b = base(spark, sf)
    edges = quantile_edges(b.where(is_train()), "amount_b", 4)
    return b.select("id", qcut("amount_b", edges).alias("amount_q"))


@query("q_h17_custom_bucket", f"""
SELECT id, CASE WHEN amount_a IS NULL THEN 'unknown' WHEN {AGE_SQL} < 5 THEN 'infant' WHEN {AGE_SQL} < 13 THEN 'child'
  WHEN {AGE_SQL} < 20 THEN 'teen' WHEN {AGE_SQL} < 60 THEN 'adult' ELSE 'senior' END AS life_stage FROM base""")
def q_h17(spark, sf):
    lad = [(5, "infant"), (13, "child"), (20, "teen"), (60, "adult")]
    return base(spark, sf).select("id", bucket(age(), lad, "senior", "unknown").alias("life_stage"))


@query("q_h18_conditional_score", """
WITH s AS (SELECT quantile_cont(amount_b, 0.25) AS q25, median(amount_b) AS med, quantile_cont(amount_b, 0.75) AS q75 FROM base)
SELECT id, round(CASE WHEN amount_b BETWEEN q25 AND q75 THEN 0 ELSE abs(amount_b - med) END, 6) AS fit_score
FROM base CROSS JOIN s""")
def q_h18(spark, sf):
    from tabforge.operators.joins import with_scalars
    from tabforge.operators.quantiles import group_quantiles
    b = base(spark, sf)
    s = group_quantiles(b, "amount_b", [0.25, 0.5, 0.75], None, ["q25", "med", "q75"])
    x = F.col("amount_b")
    score = F.when(x.between(F.col("q25"), F.col("q75")), F.lit(0.0)).otherwise(F.abs(x - F.col("med")))
    return with_scalars(b, s).select("id", F.round(score, 6).alias("fit_score"))


@query("q_h19_guarded_division", """
SELECT id, round(amount_a / nullif(n_sib, 0), 6) AS per_sib, round(amount_b / (n_par + 1e-6), 6) AS per_par FROM base""")
def q_h19(spark, sf):
    return base(spark, sf).select("id", F.round(safe_ratio("amount_a", "n_sib"), 6).alias("per_sib"),
                                  F.round(F.col("amount_b") / (F.col("n_par") + F.lit(1e-6)), 6).alias("per_par"))


@query("q_h20_timestamp_stamp")
def q_h20(spark, sf):
    """Output names stamped with the run time (no oracle: the clock differs)."""
    from tabforge.functions.numeric import file_stamp
    g = base(spark, sf).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return g.select("category", "n", F.concat(F.lit("pred_"), F.col("category"), F.lit("_"), file_stamp(),
                                             F.lit(".csv")).alias("file_name"))
