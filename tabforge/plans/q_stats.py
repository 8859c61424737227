"""Statistics and profiling (K*)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabforge.operators.common import safe_corr

from tabforge.functions.bins import qcut, quantile_edges
from tabforge.functions.text import prefix_class, title
from tabforge.operators.comparison import agreement, block_correlations, mean_std_differences, top_differences
from tabforge.operators.groups import describe
from tabforge.operators.joins import count_lookup
from tabforge.operators.profile import chi2_yates, correlations, eliminate_collinear, vif
from tabforge.operators.quantiles import group_mode, group_quantiles
from tabforge.plans.fixtures import base
from tabforge.plans.q_groups import PREFIX_SQL
from tabforge.plans.q_relational import TITLE_SQL
from tabforge.plans.registry import query
from tabforge.plans.sqlgen import erfc_sql

NUM = ["amount_a", "amount_b", "n_sib", "n_par", "label"]


def _corr_sql(cols, where=""):
    from tabforge.operators.joins import column_pairs
    return " UNION ALL ".join(
        f"SELECT '{a}' AS f1, '{b}' AS f2, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM base {where}"
        for a, b in column_pairs(cols))


@query("q_k1_correlation_matrix", _corr_sql(NUM))
def q_k1(spark, sf):
    return correlations(base(spark, sf), NUM)


@query("q_k2_high_correlation_pairs", f"""
SELECT f1, f2, corr, row_number() OVER (ORDER BY abs(corr) DESC, f1, f2) AS pos FROM ({_corr_sql(NUM)}) WHERE abs(corr) > 0.5""")
def q_k2(spark, sf):
    c = correlations(base(spark, sf), NUM).where(F.abs("corr") > 0.5)
    return c.withColumn("pos", F.row_number().over(Window.orderBy(F.abs("corr").desc(), "f1", "f2")).cast("long"))


FEATS = ["amount_a", "amount_b", "n_sib", "n_par"]


@query("q_k3_correlation_with_target", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr(CAST({c} AS DOUBLE), CAST(label AS DOUBLE)), 6) AS corr FROM base" for c in FEATS))
def q_k3(spark, sf):
    b = base(spark, sf)
    wide = b.agg(*[F.round(safe_corr(F.col(c).cast("double"), F.col("label").cast("double")), 6).alias(c) for c in FEATS])
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("corr")) for c in FEATS]))
    return wide.select(st.alias("s")).select("s.*")


# The two feature blocks of the correlation report.
BLOCKS = {"key": ["group_size", "key_len", "is_group"], "base": ["klass_num", "amount_b", "family_size", "small_family"],
          "flag": ["region_missing", "unit_missing"]}
_BLOCK_SQL = """SELECT count(*) OVER (PARTITION BY ticket) AS group_size, length(ticket) AS key_len,
  CAST(count(*) OVER (PARTITION BY ticket) > 1 AS INTEGER) AS is_group, CAST(substr(klass, 1, 1) AS INTEGER) AS klass_num, amount_b,
  n_sib + n_par + 1 AS family_size, CAST(n_sib + n_par + 1 BETWEEN 2 AND 4 AS INTEGER) AS small_family,
  CAST(region IS NULL AS INTEGER) AS region_missing, CAST(unit_code IS NULL AS INTEGER) AS unit_missing FROM base"""


def _block_pairs():
    of = [(b, c) for b, cols in BLOCKS.items() for c in cols]
    return [(x, y) for i, x in enumerate(of) for y in of[i + 1:]]


@query("q_k3_block_correlations", f"WITH t AS ({_BLOCK_SQL}), c AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS block1, '{b}' AS block2, '{x}' AS f1, '{y}' AS f2, corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)) AS r FROM t"
    for (a, x), (b, y) in _block_pairs()) + ") SELECT block1, block2, f1, f2, round(r, 6) AS corr FROM c WHERE NOT isnan(r) AND abs(r) > 0.3")
def q_k3_blocks(spark, sf):
    family = F.col("n_sib") + F.col("n_par") + 1
    t = count_lookup(base(spark, sf), "ticket", "group_size").select(
        "group_size", F.length("ticket").alias("key_len"), (F.col("group_size") > 1).cast("int").alias("is_group"),
        F.substring("klass", 1, 1).cast("int").alias("klass_num"), "amount_b", family.alias("family_size"),
        family.between(2, 4).cast("int").alias("small_family"), F.col("region").isNull().cast("int").alias("region_missing"),
        F.col("unit_code").isNull().cast("int").alias("unit_missing"))
    return block_correlations(t, BLOCKS)


VIF_COLS = ["amount_a", "amount_b", "n_sib"]
_CC = "FROM base WHERE amount_a IS NOT NULL AND amount_b IS NOT NULL AND n_sib IS NOT NULL"


@query("q_k4a_vif_centred", f"""
WITH r AS (SELECT corr(amount_a, amount_b) AS r12, corr(amount_a, CAST(n_sib AS DOUBLE)) AS r13,
                  corr(amount_b, CAST(n_sib AS DOUBLE)) AS r23 {_CC}),
d AS (SELECT *, 1 + 2 * r12 * r13 * r23 - r12 * r12 - r13 * r13 - r23 * r23 AS det FROM r)
SELECT 'amount_a' AS feature, round((1 - r23 * r23) / det, 6) AS vif FROM d
UNION ALL SELECT 'amount_b', round((1 - r13 * r13) / det, 6) FROM d
UNION ALL SELECT 'n_sib', round((1 - r12 * r12) / det, 6) FROM d""")
def q_k4a(spark, sf):
    return vif(base(spark, sf), VIF_COLS).select("feature", F.round("vif", 6).alias("vif"))


@query("q_k4b_vif_uncentred", f"""
WITH s AS (SELECT sum(amount_a * amount_a) AS a11, sum(amount_a * amount_b) AS a12, sum(amount_a * n_sib) AS a13,
                  sum(amount_b * amount_b) AS a22, sum(amount_b * n_sib) AS a23, sum(CAST(n_sib * n_sib AS DOUBLE)) AS a33 {_CC}),
d AS (SELECT *, a11 * (a22 * a33 - a23 * a23) - a12 * (a12 * a33 - a23 * a13) + a13 * (a12 * a23 - a22 * a13) AS det FROM s)
SELECT 'amount_a' AS feature, round(a11 * (a22 * a33 - a23 * a23) / det, 4) AS vif FROM d
UNION ALL SELECT 'amount_b', round(a22 * (a11 * a33 - a13 * a13) / det, 4) FROM d
UNION ALL SELECT 'n_sib', round(a33 * (a11 * a22 - a12 * a12) / det, 4) FROM d""")
def q_k4b(spark, sf):
    return vif(base(spark, sf), VIF_COLS, centred=False).select("feature", F.round("vif", 4).alias("vif"))


@query("q_k5_chi_square_2x2", f"""
WITH t AS (SELECT CAST(sum(CASE WHEN n_sib > 1 AND label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS a,
                  CAST(sum(CASE WHEN n_sib > 1 AND label = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS b,
                  CAST(sum(CASE WHEN n_sib <= 1 AND label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS c,
                  CAST(sum(CASE WHEN n_sib <= 1 AND label = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS d FROM base),
x AS (SELECT (a + b + c + d) * pow(greatest(abs(a * d - b * c) - (a + b + c + d) / 2.0, 0.0), 2)
             / ((a + b) * (c + d) * (a + c) * (b + d)) AS chi2 FROM t),
p AS (SELECT chi2, {erfc_sql('sqrt(chi2 / 2.0)')} AS pv FROM x)
SELECT round(chi2, 6) AS chi2, round(pv, 6) AS p_value, CAST(pv < 0.05 AS INTEGER) AS significant FROM p""")
def q_k5(spark, sf):
    b = base(spark, sf)
    hi, y = F.col("n_sib") > 1, F.col("label")
    t = b.agg(*[F.sum(F.when(c, 1).otherwise(0)).cast("double").alias(n) for n, c in
                [("a", hi & (y == 1)), ("b", hi & (y == 0)), ("c", ~hi & (y == 1)), ("d", ~hi & (y == 0))]])
    chi2, p = chi2_yates(F.col("a"), F.col("b"), F.col("c"), F.col("d"))
    return t.select(F.round(chi2, 6).alias("chi2"), F.round(p, 6).alias("p_value"), (p < 0.05).cast("int").alias("significant"))


@query("q_k6_distribution_shift", " UNION ALL ".join(f"""
SELECT '{c}' AS feature, round(avg({c}) FILTER (WHERE origin = 'train'), 6) AS mean_train,
  round(avg({c}) FILTER (WHERE origin = 'serve'), 6) AS mean_serve,
  round(stddev_samp({c}) FILTER (WHERE origin = 'train'), 6) AS std_train,
  round(stddev_samp({c}) FILTER (WHERE origin = 'serve'), 6) AS std_serve,
  CAST(abs(avg({c}) FILTER (WHERE origin = 'train') - avg({c}) FILTER (WHERE origin = 'serve'))
       / stddev_samp({c}) FILTER (WHERE origin = 'train') > 0.1 AS INTEGER) AS shifted FROM base""" for c in FEATS))
def q_k6(spark, sf):
    b = base(spark, sf)
    tr, te = F.col("origin") == "train", F.col("origin") == "serve"
    aggs = []
    for c in FEATS:
        aggs += [F.avg(F.when(tr, F.col(c))).alias(f"{c}|mt"), F.avg(F.when(te, F.col(c))).alias(f"{c}|ms"),
                 F.stddev_samp(F.when(tr, F.col(c))).alias(f"{c}|st"), F.stddev_samp(F.when(te, F.col(c))).alias(f"{c}|ss")]
    w = b.agg(*aggs)
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}|mt`").alias("mt"), F.col(f"`{c}|ms`").alias("ms"),
                                      F.col(f"`{c}|st`").alias("st"), F.col(f"`{c}|ss`").alias("ss")) for c in FEATS]))
    x = w.select(st.alias("s")).select("s.*")
    return x.select("feature", F.round("mt", 6).alias("mean_train"), F.round("ms", 6).alias("mean_serve"),
                    F.round("st", 6).alias("std_train"), F.round("ss", 6).alias("std_serve"),
                    (F.abs(F.col("mt") - F.col("ms")) / F.col("st") > 0.1).cast("int").alias("shifted"))


@query("q_k6_mean_std_differences", " UNION ALL ".join(f"""
SELECT '{c}' AS feature, round(ma, 6) AS mean_first, round(mb, 6) AS mean_second, round(abs(ma - mb), 6) AS mean_diff, round(sa, 6) AS std_first,
  round(sb, 6) AS std_second, round(abs(sa - sb), 6) AS std_diff, CAST(coalesce(abs(ma - mb) > 0.1, false) AS INTEGER) AS shifted
FROM (SELECT avg({c}) FILTER (WHERE origin = 'train') AS ma, avg({c}) FILTER (WHERE origin = 'serve') AS mb,
  stddev_samp({c}) FILTER (WHERE origin = 'train') AS sa, stddev_samp({c}) FILTER (WHERE origin = 'serve') AS sb FROM base)""" for c in FEATS))
def q_k6_raw(spark, sf):
    return mean_std_differences(base(spark, sf), FEATS, F.col("origin") == "train", F.col("origin") == "serve")


@query("q_k7_feature_as_predictor", """
WITH m AS (SELECT region, label AS majority FROM (SELECT region, label, row_number() OVER (PARTITION BY region ORDER BY count(*) DESC, label) AS rn
           FROM base WHERE region IS NOT NULL GROUP BY region, label) WHERE rn = 1)
SELECT round(avg(CAST(majority = label AS DOUBLE)), 6) AS accuracy, count(*) FILTER (WHERE majority <> label) AS n_errors
FROM base JOIN m USING (region)""")
def q_k7(spark, sf):
    b = base(spark, sf)
    maj = group_mode(b, "label", "region", "majority")
    j = b.join(maj, "region")
    return j.agg(F.round(F.avg((F.col("majority") == F.col("label")).cast("double")), 6).alias("accuracy"),
                 F.count(F.when(F.col("majority") != F.col("label"), 1)).alias("n_errors"))


@query("q_k8_two_feature_disagreement", """
WITH t AS (SELECT n_sib + n_par + 1 AS family, count(*) OVER (PARTITION BY ticket) AS group_size FROM base)
SELECT group_size - family AS diff, CASE WHEN group_size > family THEN '+' WHEN group_size < family THEN '-' ELSE '=' END AS sign,
       count(*) AS n FROM t GROUP BY ALL""")
def q_k8(spark, sf):
    b = count_lookup(base(spark, sf), "ticket", "group_size").withColumn("family", F.col("n_sib") + F.col("n_par") + 1)
    d = F.col("group_size") - F.col("family")
    sign = F.when(d > 0, "+").when(d < 0, "-").otherwise("=")
    return b.groupBy(d.alias("diff"), sign.alias("sign")).agg(F.count(F.lit(1)).alias("n"))


def _family(spark, sf):
    return count_lookup(base(spark, sf), "ticket", "group_size").withColumn("family", (F.col("n_sib") + F.col("n_par") + 1).cast("long"))


_FAMILY_SQL = "SELECT *, CAST(n_sib + n_par + 1 AS BIGINT) AS family, count(*) OVER (PARTITION BY ticket) AS group_size FROM base"


@query("q_k8_match_patterns", f"""
WITH t AS ({_FAMILY_SQL})
SELECT CASE WHEN family = group_size THEN 'equal' WHEN family < group_size THEN 'below' ELSE 'above' END AS pattern, count(*) AS n,
       round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM t), 6) AS share, round(avg(CAST(label AS DOUBLE)), 6) AS rate FROM t GROUP BY 1""")
def q_k8_patterns(spark, sf):
    return agreement(_family(spark, sf), "family", "group_size", "label")


@query("q_k8_top_differences", f"""
WITH t AS (SELECT *, family - group_size AS diff FROM ({_FAMILY_SQL}))
SELECT row_number() OVER (ORDER BY abs(diff) DESC, id) AS pos, id, family, group_size, diff, ticket, label FROM t WHERE diff <> 0
QUALIFY pos <= 15""")
def q_k8_top(spark, sf):
    return top_differences(_family(spark, sf), "id", "family", "group_size", 15, ["ticket", "label"])


def _per_member(spark, sf):
    return count_lookup(base(spark, sf), "ticket", "group_size").select(
        "id", "ticket", "label", "group_size", "amount_b", (F.col("amount_b") / F.col("group_size")).alias("per_member")).withColumns(
        {"diff": F.col("amount_b") - F.col("per_member"), "ratio": F.try_divide("per_member", "amount_b")})


_MEMBER_SQL = """SELECT id, ticket, label, group_size, amount_b, per_member, amount_b - per_member AS diff, per_member / nullif(amount_b, 0) AS ratio
  FROM (SELECT *, amount_b / group_size AS per_member FROM (SELECT *, count(*) OVER (PARTITION BY ticket) AS group_size FROM base))"""
MEMBER_COLS = ["amount_b", "per_member", "diff", "ratio"]


@query("q_k9_describe_amounts", f"WITH t AS ({_MEMBER_SQL}) " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
    round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75,
    round(max({c}), 6) AS max FROM t""" for c in MEMBER_COLS))
def q_k9_describe(spark, sf):
    return describe(_per_member(spark, sf), MEMBER_COLS)


@query("q_k9_by_group_size", f"""
WITH t AS ({_MEMBER_SQL})
SELECT group_size, round(avg(amount_b), 6) AS amount_mean, round(stddev_samp(amount_b), 6) AS amount_std, round(avg(per_member), 6) AS member_mean,
       round(stddev_samp(per_member), 6) AS member_std, round(avg(ratio), 6) AS ratio_mean, round(avg(CAST(label AS DOUBLE)), 6) AS rate,
       count(label) AS n FROM t GROUP BY group_size""")
def q_k9_sizes(spark, sf):
    return _per_member(spark, sf).groupBy("group_size").agg(
        F.round(F.avg("amount_b"), 6).alias("amount_mean"), F.round(F.stddev_samp("amount_b"), 6).alias("amount_std"),
        F.round(F.avg("per_member"), 6).alias("member_mean"), F.round(F.stddev_samp("per_member"), 6).alias("member_std"),
        F.round(F.avg("ratio"), 6).alias("ratio_mean"), F.round(F.avg(F.col("label").cast("double")), 6).alias("rate"), F.count("label").alias("n"))


@query("q_k9_top_differences", f"""
WITH t AS ({_MEMBER_SQL})
SELECT row_number() OVER (ORDER BY abs(diff) DESC, id) AS pos, id, amount_b, per_member, diff, ticket, group_size, label FROM t
WHERE diff <> 0 QUALIFY pos <= 10""")
def q_k9_top(spark, sf):
    t = _per_member(spark, sf).drop("diff", "ratio")
    return top_differences(t, "id", "amount_b", "per_member", 10, ["ticket", "group_size", "label"])


def _qbin_sql(col, src):
    return f"""(SELECT list_sort(list_distinct(quantile_cont({col}, [0, 0.25, 0.5, 0.75, 1.0]))) FROM {src})"""


@query("q_k9_amount_vs_per_member_quartiles", f"""
WITH t AS (SELECT id, amount_b, amount_b / count(*) OVER (PARTITION BY ticket) AS per_member FROM base),
e AS (SELECT {_qbin_sql('amount_b', 't')} AS qa, {_qbin_sql('per_member', 't')} AS qp),
b AS (SELECT CASE WHEN amount_b IS NULL THEN NULL WHEN amount_b = qa[1] THEN 0 ELSE CAST(len(list_filter(qa, lambda x: x < amount_b)) - 1 AS INTEGER) END AS amount_q,
             CASE WHEN per_member IS NULL THEN NULL WHEN per_member = qp[1] THEN 0 ELSE CAST(len(list_filter(qp, lambda x: x < per_member)) - 1 AS INTEGER) END AS member_q
      FROM t CROSS JOIN e)
SELECT amount_q, member_q, count(*) AS n FROM b WHERE amount_q IS NOT NULL GROUP BY ALL""")
def q_k9(spark, sf):
    t = count_lookup(base(spark, sf), "ticket", "_size").select(
        "id", "amount_b", (F.col("amount_b") / F.col("_size")).alias("per_member")).persist()
    ea, ep = quantile_edges(t, "amount_b", 4), quantile_edges(t, "per_member", 4)
    x = t.select(qcut("amount_b", ea).alias("amount_q"), qcut("per_member", ep).alias("member_q"))
    return x.where(F.col("amount_q").isNotNull()).groupBy("amount_q", "member_q").agg(F.count(F.lit(1)).alias("n"))


def _q_sql(col, edges):
    return (f"CASE WHEN {col} IS NULL THEN NULL WHEN {col} = {edges}[1] THEN 0 "
            f"ELSE CAST(len(list_filter({edges}, lambda x: x < {col})) - 1 AS INTEGER) END")


@query("q_k9_quartile_rates", f"""
WITH t AS ({_MEMBER_SQL}), e AS (SELECT {_qbin_sql('amount_b', 't')} AS qa, {_qbin_sql('per_member', 't')} AS qp),
b AS (SELECT label, {_q_sql('amount_b', 'qa')} AS amount_q, {_q_sql('per_member', 'qp')} AS member_q FROM t CROSS JOIN e)
SELECT amount_q, member_q, CAST(grouping(amount_q) AS INTEGER) AS all_amounts, CAST(grouping(member_q) AS INTEGER) AS all_members,
       round(avg(CAST(label AS DOUBLE)), 6) AS rate, count(*) AS n
FROM b WHERE amount_q IS NOT NULL GROUP BY GROUPING SETS ((amount_q), (member_q), (amount_q, member_q))""")
def q_k9_rates(spark, sf):
    t = _per_member(spark, sf)
    ea, ep = quantile_edges(t, "amount_b", 4), quantile_edges(t, "per_member", 4)
    x = t.select("label", qcut("amount_b", ea).alias("amount_q"), qcut("per_member", ep).alias("member_q")).where("amount_q IS NOT NULL")
    g = x.groupingSets([["amount_q"], ["member_q"], ["amount_q", "member_q"]], "amount_q", "member_q").agg(
        F.grouping("amount_q").cast("int").alias("all_amounts"), F.grouping("member_q").cast("int").alias("all_members"),
        F.round(F.avg(F.col("label").cast("double")), 6).alias("rate"), F.count(F.lit(1)).alias("n"))
    return g


@query("q_k10_id_label_check", """
SELECT round(corr(CAST(id AS DOUBLE), CAST(label AS DOUBLE)), 6) AS corr,
       CAST(abs(corr(CAST(id AS DOUBLE), CAST(label AS DOUBLE))) > 0.1 AS INTEGER) AS alert FROM base""")
def q_k10(spark, sf):
    c = safe_corr(F.col("id").cast("double"), F.col("label").cast("double"))
    return base(spark, sf).agg(F.round(c, 6).alias("corr"), (F.abs(c) > 0.1).cast("int").alias("alert"))


@query("q_k11_null_group_profile", f"""
WITH t AS (SELECT *, {TITLE_SQL} AS title FROM base WHERE amount_a IS NULL)
SELECT klass, title, count(*) AS n, round(avg(n_sib), 6) AS mean_sib, round(avg(n_par), 6) AS mean_par,
       round(avg(amount_b), 6) AS mean_amount_b, round(median(amount_b), 6) AS median_amount_b FROM t WHERE title IS NOT NULL GROUP BY klass, title""")
def q_k11(spark, sf):
    t = base(spark, sf).withColumn("title", title("full_name")).where(
        F.col("amount_a").isNull() & F.col("title").isNotNull())
    g = t.groupBy("klass", "title").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("n_sib"), 6).alias("mean_sib"),
                                        F.round(F.avg("n_par"), 6).alias("mean_par"),
                                        F.round(F.avg("amount_b"), 6).alias("mean_amount_b"))
    med = group_quantiles(t, "amount_b", [0.5], ["klass", "title"], ["median_amount_b"])
    return g.join(med.withColumn("median_amount_b", F.round("median_amount_b", 6)), ["klass", "title"])


@query("q_k12_key_prefix_profile", f"""
SELECT {PREFIX_SQL} AS prefix, count(*) AS n, round_even(avg(CAST(label AS DOUBLE)), 6) AS rate,
       round(avg(amount_b), 6) AS mean_amount, round(stddev_samp(amount_b), 6) AS std_amount, round(median(amount_b), 6) AS median_amount
FROM base GROUP BY 1 HAVING count(*) >= 5""")
def q_k12(spark, sf):
    b = base(spark, sf).withColumn("prefix", prefix_class("ticket"))
    g = b.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"), F.bround(F.avg(F.col("label").cast("double")), 6).alias("rate"),
                                F.round(F.avg("amount_b"), 6).alias("mean_amount"),
                                F.round(F.stddev_samp("amount_b"), 6).alias("std_amount"))
    med = group_quantiles(b, "amount_b", [0.5], ["prefix"], ["median_amount"])
    return g.join(med.withColumn("median_amount", F.round("median_amount", 6)), "prefix").where(F.col("n") >= 5)


def _maj_acc_sql(keys):
    k = ", ".join(keys) if keys else "1"
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    sel = f"{', '.join(keys)}, " if keys else ""
    return f"""(SELECT sum(c) FILTER (WHERE rn = 1) * 1.0 / sum(c) FROM (SELECT {sel}label, count(*) AS c,
      row_number() OVER ({part} ORDER BY count(*) DESC, label) AS rn FROM base GROUP BY {k}, label))"""


@query("q_k13_interaction_effect", f"""
WITH a AS (SELECT {_maj_acc_sql([])} AS base_acc, {_maj_acc_sql(['category'])} AS acc_a,
                  {_maj_acc_sql(['n_sib'])} AS acc_b, {_maj_acc_sql(['category', 'n_sib'])} AS acc_ab)
SELECT round(acc_a - base_acc, 6) AS lift_a, round(acc_b - base_acc, 6) AS lift_b, round(acc_ab - base_acc, 6) AS lift_ab,
       round((acc_ab - base_acc) - ((acc_a - base_acc) + (acc_b - base_acc)), 6) AS interaction,
       CASE WHEN (acc_ab - base_acc) - ((acc_a - base_acc) + (acc_b - base_acc)) > 0.001 THEN 'synergy'
            WHEN (acc_ab - base_acc) - ((acc_a - base_acc) + (acc_b - base_acc)) < -0.001 THEN 'redundant' ELSE 'additive' END AS band FROM a""")
def q_k13(spark, sf):
    b = base(spark, sf).persist()

    def maj_acc(keys):
        c = b.groupBy(*keys, "label").agg(F.count(F.lit(1)).alias("c"))
        best = c.groupBy(*keys).agg(F.max(F.struct("c", (-F.col("label")).alias("nl"))).alias("m"), F.sum("c").alias("t"))
        return best.agg((F.sum("m.c") / F.sum("t")).alias("acc"))

    a0, a, bb, ab = maj_acc([]), maj_acc(["category"]), maj_acc(["n_sib"]), maj_acc(["category", "n_sib"])
    x = (a0.select(F.col("acc").alias("b0")).crossJoin(a.select(F.col("acc").alias("a")))
         .crossJoin(bb.select(F.col("acc").alias("bb"))).crossJoin(ab.select(F.col("acc").alias("ab"))))
    inter = (F.col("ab") - F.col("b0")) - ((F.col("a") - F.col("b0")) + (F.col("bb") - F.col("b0")))
    return x.select(F.round(F.col("a") - F.col("b0"), 6).alias("lift_a"), F.round(F.col("bb") - F.col("b0"), 6).alias("lift_b"),
                    F.round(F.col("ab") - F.col("b0"), 6).alias("lift_ab"), F.round(inter, 6).alias("interaction"),
                    F.when(inter > 0.001, "synergy").when(inter < -0.001, "redundant").otherwise("additive").alias("band"))


@query("q_k14_redundant_feature_selection", f"""
WITH c AS ({_corr_sql(NUM)}),
d AS (SELECT DISTINCT f2 AS feature FROM c WHERE abs(corr) > 0.5)
SELECT f.feature, CASE WHEN d.feature IS NULL THEN 'keep' ELSE 'drop' END AS action
FROM (VALUES {", ".join(f"('{c}')" for c in NUM)}) f(feature) LEFT JOIN d ON f.feature = d.feature""")
def q_k14(spark, sf):
    c = correlations(base(spark, sf), NUM)
    drop = c.where(F.abs("corr") > 0.5).select(F.col("f2").alias("feature")).distinct().withColumn("_d", F.lit(1))
    feats = spark.createDataFrame([(x,) for x in NUM], "feature string")
    return feats.join(drop, "feature", "left").select(
        "feature", F.when(F.col("_d").isNull(), "keep").otherwise("drop").alias("action"))


# a feature that only the others together give: no pair of them correlates that much
_JOINT = "amount_a + amount_b / 20 + 300 * n_sib"
_TRIO = ["amount_a", "amount_b", "joint"]


@query("q_k14_vif_elimination", f"""
WITH x AS (SELECT amount_a, amount_b, {_JOINT} AS joint FROM base WHERE amount_a IS NOT NULL AND amount_b IS NOT NULL),
r AS (SELECT corr(amount_a, amount_b) AS r12, corr(amount_a, joint) AS r13, corr(amount_b, joint) AS r23 FROM x),
d AS (SELECT *, 1 + 2 * r12 * r13 * r23 - r12 * r12 - r13 * r13 - r23 * r23 AS det FROM r),
v AS (SELECT 'amount_a' AS feature, 1 AS pos, (1 - r23 * r23) / det AS vif, 1 / (1 - r23 * r23) AS pair FROM d
      UNION ALL SELECT 'amount_b', 2, (1 - r13 * r13) / det, 1 / (1 - r13 * r13) FROM d
      UNION ALL SELECT 'joint', 3, (1 - r12 * r12) / det, 1 / (1 - r12 * r12) FROM d),
w AS (SELECT *, row_number() OVER (ORDER BY vif DESC, pos DESC) AS rn, max(vif) OVER () > 5 AS goes FROM v)
SELECT feature, CASE WHEN goes AND rn = 1 THEN 1 ELSE 0 END AS step,
       round(CASE WHEN goes AND rn > 1 THEN (SELECT pair FROM w WHERE rn = 1) ELSE vif END, 4) AS vif,
       CASE WHEN goes AND rn = 1 THEN 'drop' ELSE 'keep' END AS action FROM w""")
def q_k14_vif(spark, sf):
    b = base(spark, sf).where("amount_a IS NOT NULL AND amount_b IS NOT NULL").withColumn("joint", F.expr(_JOINT))
    return eliminate_collinear(b, _TRIO, 5.0).withColumn("vif", F.round("vif", 4))
