"""Missing-value operators (J*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.functions.text import title
from tabforge.operators.comparison import selected_missing_flags
from tabforge.operators.impute import (ChainedRuleImputer, GroupImputer, fill_constant, fill_global,
                                       fill_in_frame, missing_flags, presence_flag)
from tabforge.operators.joins import best_match, rule_fill
from tabforge.operators.profile import missing_impact, missing_summary
from tabforge.operators.quantiles import group_mode, group_quantiles
from tabforge.plans.fixtures import base
from tabforge.plans.q_relational import TITLE_SQL, is_train
from tabforge.plans.registry import query
from tabforge.plans.sqlgen import erfc_sql, mode_sql


@query("q_j1_constant_fill", """
SELECT id, coalesce(region, 'UNKNOWN') AS region, coalesce(unit_code, 'U0') AS unit_code FROM base""")
def q_j1(spark, sf):
    return fill_constant(base(spark, sf), {"region": "UNKNOWN", "unit_code": "U0"}).select("id", "region", "unit_code")


@query("q_j2_global_median_fill", """
SELECT id, coalesce(amount_a, (SELECT median(amount_a) FROM base WHERE origin = 'train')) AS amount_a FROM base""")
def q_j2(spark, sf):
    b = base(spark, sf)
    return fill_global(b, "amount_a", "median", source=b.where(is_train())).select("id", "amount_a")


@query("q_j3_mode_fill", f"""
SELECT id, coalesce(region, ({mode_sql("region", "base WHERE origin = 'train'")})) AS region FROM base""")
def q_j3(spark, sf):
    b = base(spark, sf)
    return fill_global(b, "region", "mode", source=b.where(is_train())).select("id", "region")


@query("q_j4_in_frame_group_median", """
SELECT id, unit_code, CASE WHEN unit_code IS NULL THEN amount_a
  ELSE coalesce(amount_a, median(amount_a) OVER (PARTITION BY unit_code)) END AS amount_a FROM base""")
def q_j4(spark, sf):
    return fill_in_frame(base(spark, sf), "amount_a", ["unit_code"]).select("id", "unit_code", "amount_a")


@query("q_j5_group_then_global_median", """
WITH r AS (SELECT category, region, median(amount_a) AS v FROM base WHERE origin = 'train' AND region IS NOT NULL GROUP BY ALL),
g AS (SELECT median(amount_a) AS v0 FROM base WHERE origin = 'train')
SELECT id, coalesce(amount_a, r.v, g.v0) AS amount_a FROM base LEFT JOIN r ON base.category = r.category AND base.region = r.region
CROSS JOIN g""")
def q_j5(spark, sf):
    b = base(spark, sf)
    return GroupImputer("amount_a", [["category", "region"]]).fit(b.where(is_train())).transform(b).select("id", "amount_a")


J6_SQL = f"""
WITH t AS (SELECT *, {TITLE_SQL} AS title FROM base),
tr AS (SELECT * FROM t WHERE origin = 'train'),
rm AS (SELECT klass, region AS v FROM (SELECT klass, region, row_number() OVER (PARTITION BY klass ORDER BY count(*) DESC, region) AS rn
       FROM tr WHERE region IS NOT NULL GROUP BY klass, region) WHERE rn = 1),
gm AS (SELECT ({mode_sql("region", "tr")}) AS v),
s1 AS (SELECT t.* REPLACE (coalesce(t.region, rm.v, gm.v) AS region) FROM t LEFT JOIN rm ON t.klass = rm.klass CROSS JOIN gm),
f2 AS (SELECT klass, region, median(amount_b) AS v FROM tr WHERE region IS NOT NULL GROUP BY klass, region),
f1 AS (SELECT klass, median(amount_b) AS v FROM tr GROUP BY klass),
f0 AS (SELECT median(amount_b) AS v FROM tr),
s2 AS (SELECT s1.* REPLACE (coalesce(s1.amount_b, f2.v, f1.v, f0.v) AS amount_b) FROM s1
       LEFT JOIN f2 ON s1.klass = f2.klass AND s1.region = f2.region LEFT JOIN f1 ON s1.klass = f1.klass CROSS JOIN f0),
a2 AS (SELECT title, klass, median(amount_a) AS v FROM tr WHERE title IS NOT NULL GROUP BY title, klass),
a1 AS (SELECT title, median(amount_a) AS v FROM tr WHERE title IS NOT NULL GROUP BY title),
a0 AS (SELECT median(amount_a) AS v FROM tr),
s3 AS (SELECT s2.* REPLACE (coalesce(s2.amount_a, a2.v, a1.v, a0.v) AS amount_a) FROM s2
       LEFT JOIN a2 ON s2.title = a2.title AND s2.klass = a2.klass LEFT JOIN a1 ON s2.title = a1.title CROSS JOIN a0)"""


def j6_imputer() -> ChainedRuleImputer:
    return ChainedRuleImputer([
        GroupImputer("region", [["klass"]], stat="mode"),
        GroupImputer("amount_b", [["klass", "region"], ["klass"]]),
        GroupImputer("amount_a", [["title", "klass"], ["title"]]),
    ])


def j6_frame(spark, sf):
    b = base(spark, sf).withColumn("title", title("full_name"))
    return b, j6_imputer().fit(b.where(is_train()))


@query("q_j6_fit_transform_rule_imputer", J6_SQL + "\nSELECT id, region, amount_b, amount_a FROM s3")
def q_j6(spark, sf):
    b, m = j6_frame(spark, sf)
    return m.transform(b).select("id", "region", "amount_b", "amount_a")


RANGE_J = """
WITH rng AS (SELECT {key}, region, quantile_cont({v}, 0.25) AS q25, median({v}) AS med, quantile_cont({v}, 0.75) AS q75,
                    min({v}) AS mn, max({v}) AS mx
             FROM base WHERE origin = 'train' AND region IS NOT NULL AND {v} IS NOT NULL GROUP BY {key}, region),
probe AS (SELECT id, {key}, {v} AS x FROM base WHERE region IS NULL AND {v} IS NOT NULL),
sc AS (SELECT probe.id, rng.region, {score} AS s FROM probe JOIN rng ON probe.{key} = rng.{key} {keep}),
best AS (SELECT id, arg_min(region, struct_pack(s := s, r := region)) AS pick FROM sc GROUP BY id)
SELECT base.id, coalesce(base.region, best.pick{fallback}) AS region FROM base LEFT JOIN best ON base.id = best.id{fb_join}"""


#: Rows without a value, or without a candidate, get the overall mode (ties: the smallest name).
MODE_JOIN = f" CROSS JOIN (SELECT ({mode_sql('region', 'base WHERE origin = ' + chr(39) + 'train' + chr(39))}) AS v) gm"


def _range(spark, sf, key, v, score, keep=None, higher=False, fallback_mode=False):
    b = base(spark, sf)
    tr = b.where(is_train() & F.col("region").isNotNull())
    q = group_quantiles(tr, v, [0.25, 0.5, 0.75], [key, "region"], ["q25", "med", "q75"])
    mm = tr.where(F.col(v).isNotNull()).groupBy(key, "region").agg(F.min(v).alias("mn"), F.max(v).alias("mx"))
    cands = q.join(mm, [key, "region"]).where(F.col("med").isNotNull())
    out = best_match(b, "id", "region", [key], v, cands, "region", score(F.col(v)), keep=keep and keep(F.col(v)),
                     higher_is_better=higher)
    if fallback_mode:
        mode = group_mode(b.where(is_train()), "region", None, "value")
        out = rule_fill(out, "region", [], default=mode)
    return out.select("id", "region")


@query("q_j7_range_fit_iqr_median", RANGE_J.format(
    key="category", v="amount_a", keep="", fallback=", gm.v", fb_join=MODE_JOIN,
    score="CASE WHEN x BETWEEN q25 AND q75 THEN 0 ELSE abs(x - med) END"))
def q_j7(spark, sf):
    return _range(spark, sf, "category", "amount_a",
                  lambda x: F.when(x.between(F.col("q25"), F.col("q75")), F.lit(0.0)).otherwise(F.abs(x - F.col("med"))),
                  fallback_mode=True)


@query("q_j8_range_fit_iqr_edge", RANGE_J.format(
    key="klass", v="amount_b", keep="", fallback=", gm.v", fb_join=MODE_JOIN,
    score="CASE WHEN x BETWEEN q25 AND q75 THEN 0 ELSE least(abs(x - q25), abs(x - q75)) END"))
def q_j8(spark, sf):
    return _range(spark, sf, "klass", "amount_b",
                  lambda x: F.when(x.between(F.col("q25"), F.col("q75")), F.lit(0.0))
                  .otherwise(F.least(F.abs(x - F.col("q25")), F.abs(x - F.col("q75")))), fallback_mode=True)


@query("q_j9_range_fit_min_max", RANGE_J.format(
    key="klass", v="amount_b", keep="WHERE x BETWEEN mn AND mx",
    fallback=", gm.v", fb_join=f" CROSS JOIN (SELECT ({mode_sql('region', 'base WHERE origin = ' + chr(39) + 'train' + chr(39))}) AS v) gm",
    score="-(1 - abs(x - med) / (mx - mn + 1e-6))"))
def q_j9(spark, sf):
    return _range(spark, sf, "klass", "amount_b",
                  lambda x: F.lit(1.0) - F.abs(x - F.col("med")) / (F.col("mx") - F.col("mn") + F.lit(1e-6)),
                  keep=lambda x: x.between(F.col("mn"), F.col("mx")), higher=True, fallback_mode=True)


@query("q_j10_missing_flags", """
SELECT id, CAST(amount_a IS NULL AS INTEGER) AS amount_a_missing, CAST(region IS NULL AS INTEGER) AS region_missing,
       CAST(unit_code IS NULL AS INTEGER) AS unit_code_missing FROM base""")
def q_j10(spark, sf):
    return missing_flags(base(spark, sf), ["amount_a", "region", "unit_code"]).select(
        "id", "amount_a_missing", "region_missing", "unit_code_missing")


@query("q_j11_presence_flag", "SELECT id, CAST(unit_code IS NOT NULL AS INTEGER) AS has_unit FROM base")
def q_j11(spark, sf):
    return base(spark, sf).select("id", presence_flag("unit_code").alias("has_unit"))


IMPACT_COLS = ["region", "amount_a", "amount_b", "unit_code"]


def _impact_sql(cols, src="base"):
    rows = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS n_missing,
        count(*) FILTER (WHERE {c} IS NOT NULL) AS n_present,
        coalesce(sum(CAST(label AS DOUBLE)) FILTER (WHERE {c} IS NULL), 0) AS pm,
        coalesce(sum(CAST(label AS DOUBLE)) FILTER (WHERE {c} IS NOT NULL), 0) AS pp FROM {src}""" for c in cols)
    chi = """CASE WHEN (pm + (n_missing - pm)) * (pp + (n_present - pp)) * (pm + pp) * ((n_missing - pm) + (n_present - pp)) > 0
      THEN (pm + (n_missing - pm) + pp + (n_present - pp)) * pow(greatest(abs(pm * (n_present - pp) - (n_missing - pm) * pp)
        - (pm + (n_missing - pm) + pp + (n_present - pp)) / 2.0, 0.0), 2)
        / ((pm + (n_missing - pm)) * (pp + (n_present - pp)) * (pm + pp) * ((n_missing - pm) + (n_present - pp))) END"""
    return f"""WITH w AS ({rows}), c AS (SELECT *, {chi} AS chi2 FROM w), p AS (SELECT *, {erfc_sql('sqrt(chi2 / 2.0)')} AS pv FROM c)
SELECT "column", n_missing, n_present, round(pm / n_missing, 6) AS rate_missing, round(pp / n_present, 6) AS rate_present,
       round(pm / n_missing - pp / n_present, 6) AS diff, round(chi2, 6) AS chi2, round(pv, 6) AS p_value,
       CAST(coalesce(pv < 0.05, false) AS INTEGER) AS significant FROM p WHERE n_missing > 0"""


@query("q_j12_flag_selection", f"""
WITH imp AS ({_impact_sql(IMPACT_COLS)})
SELECT "column", CAST(abs(diff) > 0.05 OR p_value < 0.05 AS INTEGER) AS selected FROM imp""")
def q_j12(spark, sf):
    imp = missing_impact(base(spark, sf), IMPACT_COLS, "label")
    return imp.select("column", ((F.abs("diff") > 0.05) | (F.col("p_value") < 0.05)).cast("int").alias("selected"))


_SELECTED_SQL = "(SELECT list(\"column\") FROM imp WHERE abs(diff) > 0.05 OR p_value < 0.05)"


@query("q_j12_selected_flags", f"""
WITH tr AS (SELECT * FROM base WHERE origin = 'train'), imp AS ({_impact_sql(IMPACT_COLS, "tr")}), sel AS (SELECT {_SELECTED_SQL} AS s)
SELECT id, origin, array_to_string([f FOR f IN [{", ".join(f"CASE WHEN {c} IS NULL AND list_contains(s, '{c}') THEN '{c}_missing' END" for c in IMPACT_COLS)}]
       IF f IS NOT NULL], ',') AS raised, coalesce(len(s), 0) AS n_flags FROM base CROSS JOIN sel""")
def q_j12_flags(spark, sf):
    b = base(spark, sf).select("id", "origin", "label", *IMPACT_COLS)
    flags, (train, serve) = selected_missing_flags(b.where("origin = 'train'"), [b.where("origin = 'serve'")], IMPACT_COLS, "label")
    both = train.unionByName(serve)
    raised = F.concat_ws(",", *[F.when(F.col(f) == 1, f) for f in flags]) if flags else F.lit("")
    return both.select("id", "origin", raised.alias("raised"), F.lit(len(flags)).cast("long").alias("n_flags"))


@query("q_j13_missing_summary", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS n_missing,
    round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 2) AS pct FROM base
    HAVING count(*) FILTER (WHERE {c} IS NULL) > 0""" for c in
    ["id", "group_key", "klass", "category", "region", "amount_a", "amount_b", "full_name", "ticket", "unit_code",
     "n_sib", "n_par", "label", "origin"]))
def q_j13(spark, sf):
    return missing_summary(base(spark, sf)).orderBy(F.col("n_missing").desc())


@query("q_j14_missingness_impact", _impact_sql(IMPACT_COLS))
def q_j14(spark, sf):
    return missing_impact(base(spark, sf), IMPACT_COLS, "label")


@query("q_j15_train_serve_leakage_check", """
WITH a AS (SELECT klass, median(amount_a) AS v FROM base WHERE origin = 'train' GROUP BY klass),
b AS (SELECT klass, median(amount_a) AS v FROM base WHERE origin = 'serve' GROUP BY klass)
SELECT klass, round(a.v, 6) AS train_value, round(b.v, 6) AS serve_value, round(abs(a.v - b.v), 6) AS diff,
       CAST(abs(a.v - b.v) > 0.01 AS INTEGER) AS leak_flag FROM a JOIN b USING (klass)""")
def q_j15(spark, sf):
    b = base(spark, sf)
    a = group_quantiles(b.where(is_train()), "amount_a", [0.5], ["klass"], ["train_value"])
    s = group_quantiles(b.where(~is_train()), "amount_a", [0.5], ["klass"], ["serve_value"])
    d = F.abs(F.col("train_value") - F.col("serve_value"))
    return a.join(s, "klass").select("klass", F.round("train_value", 6).alias("train_value"),
                                     F.round("serve_value", 6).alias("serve_value"), F.round(d, 6).alias("diff"),
                                     (d > 0.01).cast("int").alias("leak_flag"))


@query("q_j16_rule_inspection", f"""
WITH t AS (SELECT *, {TITLE_SQL} AS title FROM base),
nul AS (SELECT klass, title, count(*) AS n_null FROM t WHERE amount_a IS NULL AND title IS NOT NULL GROUP BY klass, title),
g AS (SELECT klass, title, round(avg(amount_a), 6) AS group_mean, round(median(amount_a), 6) AS group_median, count(amount_a) AS group_count
      FROM t WHERE origin = 'train' AND title IS NOT NULL GROUP BY klass, title)
SELECT klass, title, n_null, group_mean, group_median, group_count FROM nul LEFT JOIN g USING (klass, title)""")
def q_j16(spark, sf):
    t = base(spark, sf).withColumn("title", title("full_name"))
    tr = t.where(is_train() & F.col("title").isNotNull())
    nul = t.where(F.col("amount_a").isNull() & F.col("title").isNotNull()).groupBy("klass", "title").agg(
        F.count(F.lit(1)).alias("n_null"))
    g = tr.groupBy("klass", "title").agg(F.round(F.avg("amount_a"), 6).alias("group_mean"),
                                         F.count("amount_a").alias("group_count"))
    med = group_quantiles(tr, "amount_a", [0.5], ["klass", "title"], ["group_median"])
    med = med.withColumn("group_median", F.round("group_median", 6))
    return nul.join(g.join(med, ["klass", "title"]), ["klass", "title"], "left")


@query("q_j20_remaining_null_check", J6_SQL + "\n" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS n_missing,
    round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 2) AS pct FROM s3
    HAVING count(*) FILTER (WHERE {c} IS NULL) > 0""" for c in ["region", "amount_a", "amount_b", "title", "unit_code"]))
def q_j20(spark, sf):
    b, m = j6_frame(spark, sf)
    return missing_summary(m.transform(b), ["region", "amount_a", "amount_b", "title", "unit_code"])


@query("q_j21_imputer_state_summary", J6_SQL.split(",\nrm AS")[0] + """
SELECT 'region' AS target, 'klass' AS level, count(DISTINCT klass) FILTER (WHERE region IS NOT NULL) AS n_rules FROM tr
UNION ALL SELECT 'region', 'overall', CAST(count(region) > 0 AS BIGINT) FROM tr
UNION ALL SELECT 'amount_b', 'klass|region', count(*) FROM (SELECT DISTINCT klass, region FROM tr WHERE region IS NOT NULL AND amount_b IS NOT NULL)
UNION ALL SELECT 'amount_b', 'klass', count(*) FROM (SELECT DISTINCT klass FROM tr WHERE amount_b IS NOT NULL)
UNION ALL SELECT 'amount_b', 'overall', CAST(count(amount_b) > 0 AS BIGINT) FROM tr
UNION ALL SELECT 'amount_a', 'title|klass', count(*) FROM (SELECT DISTINCT title, klass FROM tr WHERE title IS NOT NULL AND amount_a IS NOT NULL)
UNION ALL SELECT 'amount_a', 'title', count(*) FROM (SELECT DISTINCT title FROM tr WHERE title IS NOT NULL AND amount_a IS NOT NULL)
UNION ALL SELECT 'amount_a', 'overall', CAST(count(amount_a) > 0 AS BIGINT) FROM tr""")
def q_j21(spark, sf):
    _, m = j6_frame(spark, sf)
    return m.summary()
