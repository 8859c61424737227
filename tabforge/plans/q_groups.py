"""Aggregations (D*), window-type operators (E*), sort/top-k (F*), set ops (G*)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabforge.operators.common import safe_corr

from tabforge.functions.text import prefix_class, title
from tabforge.operators.common import flag
from tabforge.operators.folds import stratified_folds
from tabforge.operators.groups import (crosstab, describe, group_rate, group_size, non_null_counts,
                                       value_share)
from tabforge.operators.impute import fill_in_frame
from tabforge.operators.joins import count_lookup, top_n_per_group, with_scalars
from tabforge.operators.quantiles import group_mode, group_quantiles
from tabforge.operators.ranking import bucketed_running_sum, dense_ids
from tabforge.plans.fixtures import base, scores
from tabforge.plans.q_relational import FOLD_SQL, TITLE_SQL, is_train
from tabforge.plans.registry import query

RATE_SQL = ("count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, "
            "round_even(avg(CAST(label AS DOUBLE)), 6) AS rate")


# ---------------------------------------------------------------- D: aggregations
@query("q_d1_group_rate", f"SELECT klass, category, {RATE_SQL} FROM base GROUP BY klass, category")
def q_d1(spark, sf):
    return group_rate(base(spark, sf), ["klass", "category"], "label")


@query("q_d2_group_size", "SELECT region, count(*) AS n FROM base WHERE region IS NOT NULL GROUP BY region")
def q_d2(spark, sf):
    return group_size(base(spark, sf), "region")


@query("q_d3_value_share", """
SELECT region, count(*) AS n, round_even(count(*) / sum(count(*)) OVER (), 6) AS share
FROM base WHERE region IS NOT NULL GROUP BY region""")
def q_d3(spark, sf):
    return value_share(base(spark, sf), "region")


@query("q_d4_group_median", """
SELECT klass, category, round(median(amount_a), 6) AS median FROM base GROUP BY klass, category""")
def q_d4(spark, sf):
    q = group_quantiles(base(spark, sf), "amount_a", [0.5], ["klass", "category"], ["median"])
    return q.withColumn("median", F.round("median", 6))


@query("q_d5_group_quantiles", """
SELECT klass, category, min(amount_b) AS min, round(quantile_cont(amount_b, 0.25), 6) AS q25, round(median(amount_b), 6) AS median,
       round(quantile_cont(amount_b, 0.75), 6) AS q75, max(amount_b) AS max FROM base GROUP BY klass, category""")
def q_d5(spark, sf):
    b = base(spark, sf)
    q = group_quantiles(b, "amount_b", [0.25, 0.5, 0.75], ["klass", "category"], ["q25", "median", "q75"])
    mm = b.groupBy("klass", "category").agg(F.min("amount_b").alias("min"), F.max("amount_b").alias("max"))
    return q.join(mm, ["klass", "category"]).withColumns({c: F.round(c, 6) for c in ["q25", "median", "q75"]})


@query("q_d6_mode_smallest_tie", """
SELECT klass, region AS mode FROM (
  SELECT klass, region, row_number() OVER (PARTITION BY klass ORDER BY count(*) DESC, region) AS rn
  FROM base WHERE region IS NOT NULL GROUP BY klass, region) WHERE rn = 1""")
def q_d6(spark, sf):
    return group_mode(base(spark, sf), "region", "klass")


@query("q_d7_multi_aggregate", """
SELECT category, round(avg(amount_a), 6) AS amount_a_mean, round(stddev_samp(amount_a), 6) AS amount_a_std,
       round(median(amount_a), 6) AS amount_a_median, count(amount_a) AS amount_a_count,
       arg_min(region, id) FILTER (WHERE region IS NOT NULL) AS region_first
FROM base GROUP BY category""")
def q_d7(spark, sf):
    b = base(spark, sf)
    agg = b.groupBy("category").agg(
        F.round(F.avg("amount_a"), 6).alias("amount_a_mean"), F.round(F.stddev_samp("amount_a"), 6).alias("amount_a_std"),
        F.count("amount_a").alias("amount_a_count"),
        F.expr("min_by(region, id) FILTER (WHERE region IS NOT NULL)").alias("region_first"))
    med = group_quantiles(b, "amount_a", [0.5], ["category"], ["amount_a_median"])
    return agg.join(med, "category").withColumn("amount_a_median", F.round("amount_a_median", 6))


@query("q_d8_std_sample_population", """
SELECT klass, round(stddev_samp(amount_a), 6) AS std_samp, round(stddev_pop(amount_a), 6) AS std_pop
FROM base GROUP BY klass""")
def q_d8(spark, sf):
    return base(spark, sf).groupBy("klass").agg(F.round(F.stddev_samp("amount_a"), 6).alias("std_samp"),
                                                F.round(F.stddev_pop("amount_a"), 6).alias("std_pop"))


@query("q_d9_distinct_count", """
SELECT category, count(DISTINCT ticket) AS n_tickets, count(DISTINCT group_key) AS n_groups FROM base GROUP BY category""")
def q_d9(spark, sf):
    return base(spark, sf).groupBy("category").agg(F.count_distinct("ticket").alias("n_tickets"),
                                                   F.count_distinct("group_key").alias("n_groups"))


@query("q_d10_groups_with_property", """
SELECT count(*) AS shared_keys, CAST(sum(n) AS BIGINT) AS rows_in_shared FROM
 (SELECT ticket, count(*) AS n FROM base GROUP BY ticket HAVING count(*) > 1)""")
def q_d10(spark, sf):
    g = group_size(base(spark, sf), "ticket").where(F.col("n") > 1)
    return g.agg(F.count(F.lit(1)).alias("shared_keys"), F.sum("n").cast("long").alias("rows_in_shared"))


@query("q_d11_all_none_flags", """
SELECT ticket, count(*) AS size, CAST(sum(label) AS BIGINT) AS positives,
       CAST(sum(label) = count(*) AS INTEGER) AS all_pos, CAST(sum(label) = 0 AS INTEGER) AS none_pos
FROM base GROUP BY ticket""")
def q_d11(spark, sf):
    g = base(spark, sf).groupBy("ticket").agg(F.count(F.lit(1)).alias("size"),
                                              F.sum("label").cast("long").alias("positives"))
    return g.withColumns({"all_pos": (F.col("positives") == F.col("size")).cast("int"),
                          "none_pos": (F.col("positives") == 0).cast("int")})


@query("q_d12_crosstab", "SELECT klass, category, count(*) AS value FROM base GROUP BY klass, category")
def q_d12(spark, sf):
    return crosstab(base(spark, sf), "klass", "category")


CUBE_SQL = """SELECT CASE WHEN grouping(region) = 1 THEN 'All' ELSE region END AS region,
       CASE WHEN grouping(category) = 1 THEN 'All' ELSE category END AS category, {m} AS value
FROM base WHERE region IS NOT NULL GROUP BY CUBE (region, category)"""


@query("q_d13_crosstab_margins", CUBE_SQL.format(m="count(*)"))
def q_d13(spark, sf):
    return crosstab(base(spark, sf), "region", "category", margins=True)


@query("q_d14_crosstab_normalised_by_column", f"""
WITH c AS ({CUBE_SQL.format(m="count(*)")})
SELECT c.region, c.category, round(CAST(c.value AS DOUBLE) / t.value, 6) AS share
FROM c JOIN c t ON t.category = c.category AND t.region = 'All'""")
def q_d14(spark, sf):
    c = crosstab(base(spark, sf), "region", "category", margins=True)
    tot = c.where(F.col("region") == "All").select("category", F.col("value").alias("_tot"))
    return c.join(tot, "category").select("region", "category",
                                          F.round(F.col("value") / F.col("_tot"), 6).alias("share"))


@query("q_d15_crosstab_of_mean", """
SELECT klass, category, round(avg(CAST(label AS DOUBLE)), 6) AS value FROM base GROUP BY klass, category""")
def q_d15(spark, sf):
    c = crosstab(base(spark, sf), "klass", "category", agg=F.avg(F.col("label").cast("double")))
    return c.withColumn("value", F.round("value", 6))


@query("q_d16_group_by_expression", f"""
SELECT amount_a IS NULL AS amount_missing, {RATE_SQL} FROM base GROUP BY amount_a IS NULL""")
def q_d16(spark, sf):
    b = base(spark, sf).withColumn("amount_missing", F.col("amount_a").isNull())
    return group_rate(b, "amount_missing", "label")


@query("q_d17_imbalance_score", """
WITH g AS (SELECT klass, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, avg(CAST(label AS DOUBLE)) AS rate FROM base GROUP BY klass),
o AS (SELECT avg(CAST(label AS DOUBLE)) AS overall FROM base)
SELECT klass, n, positives, n - positives AS negatives, round(rate, 6) AS rate, round(abs(rate - overall), 6) AS imbalance
FROM g CROSS JOIN o""")
def q_d17(spark, sf):
    b = base(spark, sf)
    g = b.groupBy("klass").agg(F.count(F.lit(1)).alias("n"), F.sum("label").cast("long").alias("positives"),
                               F.avg(F.col("label").cast("double")).alias("rate"))
    o = b.agg(F.avg(F.col("label").cast("double")).alias("overall"))
    return with_scalars(g, o).select(
        "klass", "n", "positives", (F.col("n") - F.col("positives")).alias("negatives"),
        F.round("rate", 6).alias("rate"), F.round(F.abs(F.col("rate") - F.col("overall")), 6).alias("imbalance")
    ).orderBy(F.col("imbalance").desc())


DESCRIBE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
        round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(median({c}), 6) AS p50,
        round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM base""" for c in ["amount_a", "amount_b"])


@query("q_d18_describe", DESCRIBE_SQL)
def q_d18(spark, sf):
    return describe(base(spark, sf), ["amount_a", "amount_b"])


_TYPE_MAP = ("CASE typeof({c}) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
             "WHEN 'VARCHAR' THEN 'string' ELSE lower(typeof({c})) END")
_INFO_COLS = ["id", "group_key", "klass", "category", "region", "amount_a", "amount_b", "full_name", "ticket",
              "unit_code", "n_sib", "n_par", "label", "origin"]


@query("q_d19_frame_info", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", any_value({_TYPE_MAP.format(c=c)}) AS dtype, count({c}) AS non_null, count(*) AS rows FROM base"
    for c in _INFO_COLS))
def q_d19(spark, sf):
    return non_null_counts(base(spark, sf), _INFO_COLS)


@query("q_d20_match_rate", """
SELECT round(avg(CAST(CAST(coalesce(amount_b > 200000, false) AS INTEGER) = label AS DOUBLE)), 6) AS match_rate FROM base""")
def q_d20(spark, sf):
    b = base(spark, sf)
    return b.agg(F.round(F.avg((flag(F.col("amount_b") > 200000) == F.col("label")).cast("double")), 6)
                 .alias("match_rate"))


@query("q_d21_per_class_score", """
SELECT model, round(avg(proba) FILTER (WHERE label = 1), 6) AS mean_pos, round(avg(proba) FILTER (WHERE label = 0), 6) AS mean_neg,
       round(avg(proba) FILTER (WHERE label = 1) - avg(proba) FILTER (WHERE label = 0), 6) AS separation
FROM scores GROUP BY model""")
def q_d21(spark, sf):
    g = scores(spark, sf).groupBy("model").agg(
        F.avg(F.when(F.col("label") == 1, F.col("proba"))).alias("p"),
        F.avg(F.when(F.col("label") == 0, F.col("proba"))).alias("q"))
    return g.select("model", F.round("p", 6).alias("mean_pos"), F.round("q", 6).alias("mean_neg"),
                    F.round(F.col("p") - F.col("q"), 6).alias("separation"))


@query("q_d22_histogram_by_class", """
WITH r AS (SELECT min(amount_b) AS lo, max(amount_b) AS hi FROM base)
SELECT label, CAST(least(floor((amount_b - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin, count(*) AS n
FROM base CROSS JOIN r WHERE amount_b IS NOT NULL GROUP BY ALL""")
def q_d22(spark, sf):
    b = base(spark, sf)
    r = b.agg(F.min("amount_b").alias("lo"), F.max("amount_b").alias("hi"))
    x = with_scalars(b.where(F.col("amount_b").isNotNull()), r)
    binc = F.least(F.floor((F.col("amount_b") - F.col("lo")) / (F.col("hi") - F.col("lo")) * 30), F.lit(29)).cast("int")
    return x.groupBy("label", binc.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


PREFIX_SQL = r"""CASE WHEN ticket IS NULL THEN NULL
   WHEN regexp_replace(trim(ticket), '\.', '', 'g') SIMILAR TO '[0-9]+' THEN 'NUMERIC'
   WHEN length(regexp_extract(trim(ticket), '^([A-Za-z./\s]+)', 1)) > 0 THEN
     upper(regexp_replace(regexp_replace(regexp_extract(trim(ticket), '^([A-Za-z./\s]+)', 1), '[./\s]+', '_', 'g'), '^_+|_+$', '', 'g'))
   ELSE 'OTHER' END"""


@query("q_d23_category_filter_list", f"""
WITH g AS (SELECT {PREFIX_SQL} AS prefix, avg(CAST(label AS DOUBLE)) AS rate FROM base GROUP BY 1)
SELECT CASE WHEN rate > 0.52 THEN 'high' WHEN rate < 0.48 THEN 'low' ELSE 'mid' END AS band, prefix FROM g""")
def q_d23(spark, sf):
    g = base(spark, sf).withColumn("prefix", prefix_class("ticket")).groupBy("prefix").agg(
        F.avg(F.col("label").cast("double")).alias("rate"))
    band = F.when(F.col("rate") > 0.52, "high").when(F.col("rate") < 0.48, "low").otherwise("mid")
    # long form (band, member): a band's member list is never gathered into one row
    return g.select(band.alias("band"), "prefix").orderBy("band", "prefix")


# ---------------------------------------------------------------- E: window-type
@query("q_e1_group_transform_count", """
SELECT id, unit_code, CASE WHEN unit_code IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY unit_code) END AS unit_size FROM base""")
def q_e1(spark, sf):
    b = count_lookup(base(spark, sf), "unit_code", "unit_size")
    return b.select("id", "unit_code", F.coalesce(F.col("unit_size"), F.lit(1)).cast("long").alias("unit_size"))


@query("q_e2_group_transform_fill", """
SELECT id, coalesce(amount_a, median(amount_a) OVER (PARTITION BY klass)) AS amount_a FROM base""")
def q_e2(spark, sf):
    return fill_in_frame(base(spark, sf), "amount_a", ["klass"]).select("id", "amount_a")


@query("q_e3_group_rank", """
SELECT category, klass, round_even(avg(CAST(label AS DOUBLE)), 6) AS rate,
       rank() OVER (PARTITION BY category ORDER BY round_even(avg(CAST(label AS DOUBLE)), 6) DESC) AS rnk
FROM base GROUP BY category, klass""")
def q_e3(spark, sf):
    g = group_rate(base(spark, sf), ["category", "klass"], "label")
    return g.select("category", "klass", "rate",
                    F.rank().over(Window.partitionBy("category").orderBy(F.col("rate").desc())).cast("long").alias("rnk"))


@query("q_e4_first_appearance_factorize", """
SELECT ticket, CAST(row_number() OVER (ORDER BY min(id), ticket) - 1 AS BIGINT) AS code FROM base GROUP BY ticket""")
def q_e4(spark, sf):
    return dense_ids(base(spark, sf), "ticket", "id")


GAIN_SQL = """
WITH m AS (SELECT model, CAST(substr(model, 2) AS INTEGER) AS k FROM (SELECT DISTINCT model FROM scores)),
n AS (SELECT DISTINCT k AS n FROM m),
v AS (SELECT n.n, s.id, s.label, avg(s.proba) AS p FROM scores s JOIN m ON s.model = m.model JOIN n ON m.k <= n.n GROUP BY n.n, s.id, s.label),
a AS (SELECT n, avg(CAST((CASE WHEN p >= 0.5 THEN 1 ELSE 0 END) = label AS DOUBLE)) AS acc FROM v GROUP BY n)"""


def _acc_by_prefix(spark, sf):
    s = scores(spark, sf).withColumn("k", F.substring("model", 2, 10).cast("int"))
    ns = s.select(F.col("k").alias("n")).distinct()
    v = s.join(F.broadcast(ns), F.col("k") <= F.col("n")).groupBy("n", "id", "label").agg(F.avg("proba").alias("p"))
    return v.groupBy("n").agg(F.avg(((F.col("p") >= 0.5).cast("int") == F.col("label")).cast("double")).alias("acc"))


@query("q_e5_step_gain", GAIN_SQL + """,
g AS (SELECT n, acc, acc - lag(acc) OVER (ORDER BY n) AS gain FROM a)
SELECT n, round(acc, 6) AS acc, round(gain, 6) AS gain,
       CAST(gain < 0.5 * lag(gain) OVER (ORDER BY n) AS INTEGER) AS diminishing FROM g""")
def q_e5(spark, sf):
    """Gain of each step over the previous one; a step is diminishing when
    its gain is below half the previous gain (the stopping rule)."""
    a = _acc_by_prefix(spark, sf)
    w = Window.orderBy("n")  # one row per step count: a bounded table
    g = a.withColumn("gain", F.col("acc") - F.lag("acc").over(w))
    return g.select("n", F.round("acc", 6).alias("acc"), F.round("gain", 6).alias("gain"),
                    (F.col("gain") < F.lit(0.5) * F.lag("gain").over(w)).cast("int").alias("diminishing"))


@query("q_e6_running_totals", """
WITH c AS (SELECT model, proba, CAST(sum(label) AS BIGINT) AS pos, CAST(count(*) - sum(label) AS BIGINT) AS neg FROM scores GROUP BY model, proba)
SELECT model, proba, CAST(sum(pos) OVER (PARTITION BY model ORDER BY proba DESC) AS BIGINT) AS cum_pos,
       CAST(sum(neg) OVER (PARTITION BY model ORDER BY proba DESC) AS BIGINT) AS cum_neg FROM c""")
def q_e6(spark, sf):
    c = scores(spark, sf).groupBy("model", "proba").agg(
        F.sum("label").cast("long").alias("pos"), (F.count(F.lit(1)) - F.sum("label")).cast("long").alias("neg"))
    r = bucketed_running_sum(c, "model", "proba", ["pos", "neg"], descending=True)
    return r.select("model", "proba", F.col("cum_pos").cast("long").alias("cum_pos"),
                    F.col("cum_neg").cast("long").alias("cum_neg"))


@query("q_e7_diff_from_first", """
WITH a AS (SELECT model, avg(CAST((CASE WHEN proba >= 0.5 THEN 1 ELSE 0 END) = label AS DOUBLE)) AS acc FROM scores GROUP BY model)
SELECT model, round(acc, 6) AS acc, round(acc - first_value(acc) OVER (ORDER BY model), 6) AS change FROM a""")
def q_e7(spark, sf):
    a = scores(spark, sf).groupBy("model").agg(
        F.avg(((F.col("proba") >= 0.5).cast("int") == F.col("label")).cast("double")).alias("acc"))
    w = Window.orderBy("model").rowsBetween(Window.unboundedPreceding, 0)
    return a.select("model", F.round("acc", 6).alias("acc"),
                    F.round(F.col("acc") - F.first("acc").over(w), 6).alias("change"))


@query("q_e8_fold_rank", f"SELECT id, label, {FOLD_SQL} AS fold FROM base")
def q_e8(spark, sf):
    return stratified_folds(base(spark, sf).select("id", "label"), "id", "label")


# ---------------------------------------------------------------- F: sort / top-k
@query("q_f1_sort", "SELECT id, amount_b FROM base ORDER BY amount_b DESC NULLS LAST, id")
def q_f1(spark, sf):
    return base(spark, sf).select("id", "amount_b").orderBy(F.col("amount_b").desc_nulls_last(), "id")


@query("q_f2_sort_by_abs", """
WITH c AS (SELECT category, avg(amount_a) - (SELECT avg(amount_a) FROM base) AS dev FROM base GROUP BY category)
SELECT category, round(dev, 6) AS dev, row_number() OVER (ORDER BY abs(dev) DESC, category) AS pos FROM c""")
def q_f2(spark, sf):
    b = base(spark, sf)
    c = with_scalars(b.groupBy("category").agg(F.avg("amount_a").alias("m")), b.agg(F.avg("amount_a").alias("o")))
    c = c.select("category", (F.col("m") - F.col("o")).alias("dev"))
    return c.select("category", F.round("dev", 6).alias("dev"),
                    F.row_number().over(Window.orderBy(F.abs("dev").desc(), "category")).cast("long").alias("pos"))


@query("q_f3_sort_by_key", f"""
SELECT klass, {RATE_SQL}, row_number() OVER (ORDER BY klass) AS pos FROM base GROUP BY klass""")
def q_f3(spark, sf):
    g = group_rate(base(spark, sf), "klass", "label")
    return g.withColumn("pos", F.row_number().over(Window.orderBy("klass")).cast("long")).orderBy("klass")


@query("q_f4_top_n", "SELECT id, amount_b FROM base ORDER BY amount_b DESC NULLS LAST, id LIMIT 10")
def q_f4(spark, sf):
    return base(spark, sf).select("id", "amount_b").orderBy(F.col("amount_b").desc_nulls_last(), "id").limit(10)


@query("q_f5_nlargest_derived", """
SELECT id, round(amount_b / (n_sib + n_par + 1), 6) AS per_member FROM base WHERE amount_b IS NOT NULL
ORDER BY amount_b / (n_sib + n_par + 1) DESC, id LIMIT 5""")
def q_f5(spark, sf):
    b = base(spark, sf).where(F.col("amount_b").isNotNull()).withColumn(
        "_pm", F.col("amount_b") / (F.col("n_sib") + F.col("n_par") + 1))
    return b.orderBy(F.col("_pm").desc(), "id").limit(5).select("id", F.round("_pm", 6).alias("per_member"))


@query("q_f6_argmax_first_tie", """
SELECT arg_min(klass, struct_pack(r := -round_even(avg_rate, 6), k := klass)) AS best_klass,
       round_even(max(avg_rate), 6) AS best_rate
FROM (SELECT klass, avg(CAST(label AS DOUBLE)) AS avg_rate FROM base GROUP BY klass)""")
def q_f6(spark, sf):
    g = group_rate(base(spark, sf), "klass", "label")
    best = g.agg(F.min(F.struct((-F.col("rate")).alias("r"), F.col("klass").alias("k"))).alias("b"))
    return best.select(F.col("b.k").alias("best_klass"), (-F.col("b.r")).alias("best_rate"))


@query("q_f7_top1_per_group", """
SELECT group_key, id, amount_b FROM (SELECT group_key, id, amount_b,
  row_number() OVER (PARTITION BY group_key ORDER BY amount_b DESC NULLS LAST, id) AS rn FROM base) WHERE rn = 1""")
def q_f7(spark, sf):
    b = base(spark, sf).select("group_key", "id", "amount_b")
    return top_n_per_group(b, "group_key", [F.col("amount_b").desc_nulls_last(), F.col("id")], 1, salt_by=["id"])


@query("q_f8_best_worst_of_groups", """
WITH g AS (SELECT category, klass, round_even(avg(CAST(label AS DOUBLE)), 6) AS rate FROM base GROUP BY category, klass)
SELECT category, arg_min(klass, struct_pack(r := -rate, k := klass)) AS best_klass,
       arg_min(klass, struct_pack(r := rate, k := klass)) AS worst_klass FROM g GROUP BY category""")
def q_f8(spark, sf):
    g = group_rate(base(spark, sf), ["category", "klass"], "label")
    agg = g.groupBy("category").agg(
        F.min(F.struct((-F.col("rate")).alias("r"), F.col("klass").alias("k"))).alias("best"),
        F.min(F.struct(F.col("rate").alias("r"), F.col("klass").alias("k"))).alias("worst"))
    return agg.select("category", F.col("best.k").alias("best_klass"), F.col("worst.k").alias("worst_klass"))


# ---------------------------------------------------------------- G: set operations
@query("q_g1_union_by_name", """
SELECT id, amount_a, label FROM base WHERE origin = 'train'
UNION ALL SELECT id, amount_a, NULL AS label FROM base WHERE origin = 'serve'""")
def q_g1(spark, sf):
    b = base(spark, sf)
    tr = b.where(is_train()).select("id", "amount_a", "label")
    te = b.where(~is_train()).select("id", "amount_a")
    return tr.unionByName(te, allowMissingColumns=True)


@query("q_g2_column_concat", f"""
SELECT id, n_sib + n_par + 1 AS family, CAST(n_sib + n_par = 0 AS INTEGER) AS is_alone, {TITLE_SQL} AS title,
       CAST(unit_code IS NOT NULL AS INTEGER) AS has_unit FROM base""")
def q_g2(spark, sf):
    b = base(spark, sf)
    return b.withColumns({"family": F.col("n_sib") + F.col("n_par") + 1,
                          "is_alone": (F.col("n_sib") + F.col("n_par") == 0).cast("int"),
                          "title": title("full_name"),
                          "has_unit": F.col("unit_code").isNotNull().cast("int")}
                         ).select("id", "family", "is_alone", "title", "has_unit")


@query("q_g3_union_key_counts", """
SELECT ticket, count(*) AS n FROM (SELECT ticket FROM base WHERE origin = 'train' UNION ALL
                                   SELECT ticket FROM base WHERE origin = 'serve') GROUP BY ticket""")
def q_g3(spark, sf):
    b = base(spark, sf)
    u = b.where(is_train()).select("ticket").unionByName(b.where(~is_train()).select("ticket"))
    return group_size(u, "ticket")


_MISS_COLS = ["region", "amount_a", "amount_b", "unit_code", "full_name", "label"]


def _missing_names(df):
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_missing")) for c in _MISS_COLS]))
    wide = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in _MISS_COLS])
    return wide.select(st.alias("s")).select("s.*").where(F.col("n_missing") > 0).select("column")


def _miss_sql(origin):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\" FROM (SELECT * REPLACE ({'CAST(NULL AS INTEGER)' if origin == 'serve' else 'label'} AS label) "
        f"FROM base WHERE origin = '{origin}') HAVING count(*) FILTER (WHERE {c} IS NULL) > 0"
        for c in _MISS_COLS)


@query("q_g4_missing_column_sets", f"""
WITH tr AS ({_miss_sql('train')}), te AS ({_miss_sql('serve')})
SELECT "column", 'only_train' AS status FROM (SELECT "column" FROM tr EXCEPT SELECT "column" FROM te)
UNION ALL SELECT "column", 'only_serve' FROM (SELECT "column" FROM te EXCEPT SELECT "column" FROM tr)
UNION ALL SELECT "column", 'both' FROM (SELECT "column" FROM tr INTERSECT SELECT "column" FROM te)""")
def q_g4(spark, sf):
    b = base(spark, sf)
    tr = _missing_names(b.where(is_train()).withColumn("label", F.col("label")))
    te = _missing_names(b.where(~is_train()).withColumn("label", F.lit(None).cast("int")))
    return (tr.subtract(te).withColumn("status", F.lit("only_train"))
            .unionByName(te.subtract(tr).withColumn("status", F.lit("only_serve")))
            .unionByName(tr.intersect(te).withColumn("status", F.lit("both"))))


_FEATS = ["amount_a", "amount_b", "n_sib", "n_par"]


@query("q_g5_feature_set_difference", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CASE WHEN abs(corr({c}, label)) > 0.05 THEN 'kept' ELSE 'removed' END AS status FROM base"
    for c in _FEATS))
def q_g5(spark, sf):
    b = base(spark, sf)
    wide = b.agg(*[safe_corr(c, F.col("label").cast("double")).alias(c) for c in _FEATS])
    kept = F.filter(F.array(*[F.when(F.abs(F.col(c)) > 0.05, F.lit(c)) for c in _FEATS]), lambda x: x.isNotNull())
    allf = F.array(*[F.lit(c) for c in _FEATS])
    x = wide.select(kept.alias("kept"), F.array_except(allf, kept).alias("removed"))
    return (x.select(F.explode("kept").alias("feature"), F.lit("kept").alias("status"))
            .unionByName(x.select(F.explode("removed").alias("feature"), F.lit("removed").alias("status"))))


@query("q_g6_distinct", "SELECT DISTINCT klass, category FROM base")
def q_g6(spark, sf):
    return base(spark, sf).select("klass", "category").distinct()
