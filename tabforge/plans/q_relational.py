"""Projection, filter, predicate (B*), joins (C*) and set operations (G*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.functions.text import prefix_class, title
from tabforge.operators.common import flag
from tabforge.operators.folds import stratified_folds
from tabforge.operators.groups import group_rate, group_size
from tabforge.operators.impute import GroupImputer, group_stat
from tabforge.operators.joins import (best_match, column_pairs, count_lookup, dict_lookup,
                                      pair_join, rule_fill, with_scalars)
from tabforge.operators.quantiles import group_median
from tabforge.plans.fixtures import base, read_table, scores
from tabforge.plans.registry import query

TITLE_SQL = r"nullif(regexp_extract(full_name, ' ([A-Za-z]+)\.', 1), '')"


def is_train():
    return F.col("origin") == "train"


def _train(spark, sf):
    return base(spark, sf).where(is_train())


# ---------------------------------------------------------------- B: projection / filter
@query("q_b1_feature_projection", "SELECT id, klass, category, amount_a, n_sib, n_par, label FROM base")
def q_b1(spark, sf):
    return base(spark, sf).select("id", "klass", "category", "amount_a", "n_sib", "n_par", "label")


@query("q_b2_boolean_filter", """
SELECT id, amount_a, category, region FROM base
WHERE coalesce(amount_a > 5000 AND category = 'F', false) OR NOT coalesce(region = 'ASIA', false)""")
def q_b2(spark, sf):
    c = (F.coalesce((F.col("amount_a") > 5000) & (F.col("category") == "F"), F.lit(False))
         | ~F.coalesce(F.col("region") == "ASIA", F.lit(False)))
    return base(spark, sf).where(c).select("id", "amount_a", "category", "region")


@query("q_b3_membership_filter", "SELECT id, klass FROM base WHERE klass IN ('1-URGENT', '2-HIGH')")
def q_b3(spark, sf):
    return base(spark, sf).where(F.col("klass").isin(["1-URGENT", "2-HIGH"])).select("id", "klass")


@query("q_b3_membership_semi_join", """
SELECT id, group_key FROM base WHERE group_key IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def q_b3_semi(spark, sf):
    keys = read_table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING") \
        .select(F.col("c_custkey").alias("group_key"))
    return base(spark, sf).join(keys, "group_key", "left_semi").select("id", "group_key")


@query("q_b4_range_flag", """
SELECT id, CAST(coalesce(amount_a BETWEEN 2000 AND 6000, false) AS INTEGER) AS mid_amount,
       CAST(n_sib BETWEEN 1 AND 2 AS INTEGER) AS small_sib FROM base""")
def q_b4(spark, sf):
    return base(spark, sf).select("id", flag(F.col("amount_a").between(2000, 6000)).alias("mid_amount"),
                                  flag(F.col("n_sib").between(1, 2)).alias("small_sib"))


@query("q_b5_equality_flag", """
SELECT id, CAST(coalesce(category = 'F', false) AS INTEGER) AS is_f,
       CAST(coalesce(substr(unit_code, 1, 1) IN ('D', 'E', 'B'), false) AS INTEGER) AS unit_any FROM base""")
def q_b5(spark, sf):
    return base(spark, sf).select("id", flag(F.col("category") == "F").alias("is_f"),
                                  flag(F.substring("unit_code", 1, 1).isin("D", "E", "B")).alias("unit_any"))


@query("q_b6_threshold_flag", """
SELECT id, CAST(coalesce(amount_a < 0, false) AS INTEGER) AS is_low,
       CAST(coalesce(amount_b >= 300000, false) AS INTEGER) AS is_high FROM base""")
def q_b6(spark, sf):
    return base(spark, sf).select("id", flag(F.col("amount_a") < 0).alias("is_low"),
                                  flag(F.col("amount_b") >= 300000).alias("is_high"))


@query("q_b7_null_predicates", "SELECT id, region FROM base WHERE amount_a IS NULL AND region IS NOT NULL")
def q_b7(spark, sf):
    return base(spark, sf).where(F.col("amount_a").isNull() & F.col("region").isNotNull()).select("id", "region")


@query("q_b8_drop_columns", "SELECT * EXCLUDE (full_name, ticket, unit_code) FROM base")
def q_b8(spark, sf):
    return base(spark, sf).drop("full_name", "ticket", "unit_code")


@query("q_b9_flatten_agg_names", """
SELECT category, round(avg(amount_b), 6) AS amount_b_mean, max(amount_b) AS amount_b_max,
       count(amount_b) AS amount_b_count FROM base GROUP BY category""")
def q_b9(spark, sf):
    return base(spark, sf).groupBy("category").agg(
        F.round(F.avg("amount_b"), 6).alias("amount_b_mean"), F.max("amount_b").alias("amount_b_max"),
        F.count("amount_b").alias("amount_b_count"))


@query("q_b10_cast", """
SELECT id, CAST(floor(amount_a) AS BIGINT) AS amount_floor, CAST(n_sib AS VARCHAR) AS n_sib_text,
       CAST(label AS DOUBLE) AS label_d FROM base""")
def q_b10(spark, sf):
    return base(spark, sf).select("id", F.floor("amount_a").cast("long").alias("amount_floor"),
                                  F.col("n_sib").cast("string").alias("n_sib_text"),
                                  F.col("label").cast("double").alias("label_d"))


@query("q_b11_literal_origin", """
SELECT id, 'train' AS dataset, label AS target FROM base WHERE origin = 'train'
UNION ALL SELECT id, 'test' AS dataset, -1 AS target FROM base WHERE origin = 'serve'""")
def q_b11(spark, sf):
    b = base(spark, sf)
    tr = b.where(is_train()).select("id", F.lit("train").alias("dataset"), F.col("label").alias("target"))
    te = b.where(~is_train()).select("id", F.lit("test").alias("dataset"), F.lit(-1).alias("target"))
    return tr.unionByName(te)


@query("q_b12_having_filter", "SELECT group_key, count(*) AS n FROM base GROUP BY group_key HAVING count(*) >= 10")
def q_b12(spark, sf):
    return group_size(base(spark, sf), "group_key").where(F.col("n") >= 10)


@query("q_b13_assign_aggregate", """
SELECT n_sib + n_par + 1 AS family, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives,
       round_even(avg(CAST(label AS DOUBLE)), 6) AS rate FROM base GROUP BY n_sib + n_par + 1""")
def q_b13(spark, sf):
    b = base(spark, sf).withColumn("family", F.col("n_sib") + F.col("n_par") + 1)
    return group_rate(b, "family", "label")


@query("q_b14_mismatch_rows", """
SELECT id, amount_b, label, CAST(coalesce(amount_b > 200000, false) AS INTEGER) AS pred FROM base
WHERE CAST(coalesce(amount_b > 200000, false) AS INTEGER) IS DISTINCT FROM label""")
def q_b14(spark, sf):
    b = base(spark, sf).withColumn("pred", flag(F.col("amount_b") > 200000))
    return b.where(~F.col("pred").eqNullSafe(F.col("label"))).select("id", "amount_b", "label", "pred")


@query("q_b15_zero_as_missing", """
WITH m AS (SELECT median(amount_b) AS med FROM base)
SELECT id, CASE WHEN coalesce(amount_b, med) = 0 THEN med ELSE coalesce(amount_b, med) END AS amount_b_filled
FROM base CROSS JOIN m""")
def q_b15(spark, sf):
    b = base(spark, sf)
    med = group_median(b, "amount_b", None, "med")
    filled = F.coalesce(F.col("amount_b"), F.col("med"))
    return with_scalars(b, med).select("id", F.when(filled == 0, F.col("med")).otherwise(filled)
                                       .alias("amount_b_filled"))


@query("q_b16_inf_to_null_fill", """
WITH r AS (SELECT id, CASE WHEN n_sib = 0 THEN NULL ELSE amount_b / n_sib END AS ratio FROM base),
m AS (SELECT median(ratio) AS med FROM r)
SELECT id, round(coalesce(ratio, med), 6) AS ratio FROM r CROSS JOIN m""")
def q_b16(spark, sf):
    r = base(spark, sf).select("id", F.try_divide(F.col("amount_b"), F.col("n_sib").cast("double")).alias("ratio"))
    med = group_median(r, "ratio", None, "med")
    return with_scalars(r, med).select("id", F.round(F.coalesce("ratio", "med"), 6).alias("ratio"))


# ---------------------------------------------------------------- C: joins
@query("q_c1_count_lookup", "SELECT id, ticket, count(*) OVER (PARTITION BY ticket) AS key_count FROM base")
def q_c1(spark, sf):
    return count_lookup(base(spark, sf), "ticket").select("id", "ticket", "key_count")


# Ordinal code per title.
TITLE_CODES = {"Mr": 0, "Miss": 1, "Mrs": 2, "Master": 3, "Dr": 4}


@query("q_c2_dict_lookup", f"""
SELECT id, CASE {TITLE_SQL} WHEN 'Mr' THEN 0 WHEN 'Miss' THEN 1 WHEN 'Mrs' THEN 2 WHEN 'Master' THEN 3
       WHEN 'Dr' THEN 4 END AS title_code FROM base""")
def q_c2(spark, sf):
    b = base(spark, sf).withColumn("title", title("full_name"))
    return dict_lookup(b, "title", TITLE_CODES, "title_code").select("id", "title_code")


@query("q_c3_rule_join_one_fallback", """
WITH r1 AS (SELECT klass, category, median(amount_a) AS v FROM base WHERE origin = 'train' GROUP BY klass, category),
r0 AS (SELECT median(amount_a) AS v0 FROM base WHERE origin = 'train')
SELECT id, coalesce(amount_a, r1.v, r0.v0) AS amount_a FROM base LEFT JOIN r1 USING (klass, category) CROSS JOIN r0""")
def q_c3(spark, sf):
    m = GroupImputer("amount_a", [["klass", "category"]]).fit(_train(spark, sf))
    return m.transform(base(spark, sf)).select("id", "amount_a")


@query("q_c4_rule_join_two_fallbacks", f"""
WITH t AS (SELECT *, {TITLE_SQL} AS title FROM base),
r2 AS (SELECT klass, title, median(amount_a) AS v2 FROM t WHERE origin = 'train' AND title IS NOT NULL GROUP BY klass, title),
r1 AS (SELECT title, median(amount_a) AS v1 FROM t WHERE origin = 'train' AND title IS NOT NULL GROUP BY title),
r0 AS (SELECT median(amount_a) AS v0 FROM t WHERE origin = 'train')
SELECT id, coalesce(t.amount_a, r2.v2, r1.v1, r0.v0) AS amount_a
FROM t LEFT JOIN r2 ON t.klass = r2.klass AND t.title = r2.title LEFT JOIN r1 ON t.title = r1.title CROSS JOIN r0""")
def q_c4(spark, sf):
    b = base(spark, sf).withColumn("title", title("full_name"))
    m = GroupImputer("amount_a", [["klass", "title"], ["title"]]).fit(b.where(is_train()))
    return m.transform(b).select("id", "amount_a")


@query("q_c5_composite_parent_constant", """
WITH r2 AS (SELECT klass, region, median(amount_b) AS v2 FROM base WHERE origin = 'train' AND region IS NOT NULL GROUP BY klass, region),
r1 AS (SELECT klass, median(amount_b) AS v1 FROM base WHERE origin = 'train' GROUP BY klass)
SELECT id, coalesce(amount_b, r2.v2, r1.v1, CAST(0 AS DOUBLE)) AS amount_b
FROM base LEFT JOIN r2 ON base.klass = r2.klass AND base.region = r2.region LEFT JOIN r1 ON base.klass = r1.klass""")
def q_c5(spark, sf):
    m = GroupImputer("amount_b", [["klass", "region"], ["klass"]], overall=False, constant=0.0).fit(_train(spark, sf))
    return m.transform(base(spark, sf)).select("id", "amount_b")


RANGE_SQL = """
WITH rng AS (SELECT klass, region, quantile_cont(amount_b, 0.25) AS q25, median(amount_b) AS med,
                    quantile_cont(amount_b, 0.75) AS q75
             FROM base WHERE origin = 'train' AND region IS NOT NULL AND amount_b IS NOT NULL GROUP BY klass, region),
probe AS (SELECT id, klass, amount_b FROM base WHERE region IS NULL AND amount_b IS NOT NULL),
sc AS (SELECT probe.id, rng.region, {score} AS s FROM probe JOIN rng ON probe.klass = rng.klass),
best AS (SELECT id, arg_min(region, struct_pack(s := s, r := region)) AS pick FROM sc GROUP BY id)
SELECT base.id, coalesce(base.region, best.pick) AS region FROM base LEFT JOIN best ON base.id = best.id"""


def _range_fit(spark, sf, score_fn):
    b = base(spark, sf)
    from tabforge.operators.quantiles import group_quantiles
    rng = group_quantiles(b.where(is_train() & F.col("region").isNotNull()), "amount_b", [0.25, 0.5, 0.75],
                          ["klass", "region"], ["q25", "med", "q75"])
    return best_match(b, "id", "region", ["klass"], "amount_b", rng, "region",
                      score_fn(F.col("amount_b"))).select("id", "region")


@query("q_c6_best_match_join", RANGE_SQL.format(
    score="CASE WHEN amount_b BETWEEN q25 AND q75 THEN 0 ELSE abs(amount_b - med) END"))
def q_c6(spark, sf):
    return _range_fit(spark, sf, lambda x: F.when(x.between(F.col("q25"), F.col("q75")), F.lit(0.0))
                      .otherwise(F.abs(x - F.col("med"))))


@query("q_c7_model_pair_join", """
SELECT a.model AS item_a, b.model AS item_b, count(*) AS n
FROM scores a JOIN scores b ON a.id = b.id AND a.model < b.model GROUP BY a.model, b.model""")
def q_c7(spark, sf):
    p = pair_join(scores(spark, sf), "id", "model", ["proba"])
    return p.groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("n"))


PAIR_COLS = ["amount_a", "amount_b", "n_sib", "n_par", "label"]


def _pairs_sql(expr: str) -> str:
    parts = []
    for a, b in column_pairs(PAIR_COLS):
        parts.append(f"SELECT '{a}' AS f1, '{b}' AS f2, {expr.format(a=a, b=b)} AS value FROM base")
    return " UNION ALL ".join(parts)


@query("q_c8_feature_pairs", _pairs_sql("count(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN 1 END)"))
def q_c8(spark, sf):
    b = base(spark, sf)
    pairs = column_pairs(PAIR_COLS)
    wide = b.agg(*[F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias(f"{x}|{y}")
                   for x, y in pairs])
    st = F.explode(F.array(*[F.struct(F.lit(x).alias("f1"), F.lit(y).alias("f2"), F.col(f"`{x}|{y}`").alias("value"))
                             for x, y in pairs]))
    return wide.select(st.alias("s")).select("s.*")


ACC_SQL = "SELECT model, avg(CAST((CASE WHEN proba >= 0.5 THEN 1 ELSE 0 END) = label AS DOUBLE)) AS acc FROM scores GROUP BY model"


def _acc(spark, sf):
    s = scores(spark, sf)
    return s.groupBy("model").agg(F.avg(((F.col("proba") >= 0.5).cast("int") == F.col("label")).cast("double")).alias("acc"))


@query("q_c9_baseline_variant_join", f"""
WITH a AS ({ACC_SQL})
SELECT v.model, round(v.acc, 6) AS acc, round(v.acc - b.acc, 6) AS delta FROM a v JOIN a b ON b.model = 'm1'""")
def q_c9(spark, sf):
    a = _acc(spark, sf)
    bl = a.where(F.col("model") == "m1").select(F.col("acc").alias("base_acc"))
    return with_scalars(a, bl).select("model", F.round("acc", 6).alias("acc"),
                                      F.round(F.col("acc") - F.col("base_acc"), 6).alias("delta"))


FOLD_SQL = "CAST((row_number() OVER (PARTITION BY label ORDER BY md5(concat('42:', CAST(id AS VARCHAR))), id) - 1) % 5 AS INTEGER)"


@query("q_c10_result_join", f"""
WITH f AS (SELECT id, {FOLD_SQL} AS fold FROM (SELECT DISTINCT id, label FROM scores)),
pf AS (SELECT model, fold, avg(CAST((CASE WHEN proba >= 0.5 THEN 1 ELSE 0 END) = label AS DOUBLE)) AS acc
       FROM scores JOIN f USING (id) GROUP BY model, fold),
st AS (SELECT model, stddev_pop(acc) AS fold_std FROM pf GROUP BY model),
o AS ({ACC_SQL})
SELECT model, round(o.acc, 6) AS oof_acc, round(st.fold_std, 6) AS fold_std FROM o JOIN st USING (model)""")
def q_c10(spark, sf):
    s = scores(spark, sf)
    folds = stratified_folds(s.select("id", "label").distinct(), "id", "label").select("id", "fold")
    sf_ = s.join(folds, "id")
    pf = sf_.groupBy("model", "fold").agg(
        F.avg(((F.col("proba") >= 0.5).cast("int") == F.col("label")).cast("double")).alias("acc"))
    st = pf.groupBy("model").agg(F.stddev_pop("acc").alias("fold_std"))
    return _acc(spark, sf).join(st, "model").select(
        "model", F.round("acc", 6).alias("oof_acc"), F.round("fold_std", 6).alias("fold_std"))


@query("q_c11_key_attach", """
SELECT d.doc_id, d.n_chars, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_c11(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    lab = read_table(spark, sf, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id", "left")


@query("q_c12_target_lookup", """
WITH t AS (SELECT *, CASE WHEN ticket IS NULL THEN NULL
   WHEN regexp_replace(trim(ticket), '\\.', '', 'g') SIMILAR TO '[0-9]+' THEN 'NUMERIC'
   WHEN length(regexp_extract(trim(ticket), '^([A-Za-z./\\s]+)', 1)) > 0 THEN
     upper(regexp_replace(regexp_replace(regexp_extract(trim(ticket), '^([A-Za-z./\\s]+)', 1), '[./\\s]+', '_', 'g'), '^_+|_+$', '', 'g'))
   ELSE 'OTHER' END AS prefix FROM base),
r AS (SELECT prefix, avg(CAST(label AS DOUBLE)) AS te FROM t WHERE origin = 'train' AND prefix IS NOT NULL GROUP BY prefix),
g AS (SELECT avg(CAST(label AS DOUBLE)) AS te0 FROM t WHERE origin = 'train')
SELECT id, prefix, round(coalesce(r.te, g.te0), 6) AS target_mean FROM t LEFT JOIN r USING (prefix) CROSS JOIN g
WHERE origin = 'serve'""")
def q_c12(spark, sf):
    b = base(spark, sf).withColumn("prefix", prefix_class("ticket"))
    tr = b.where(is_train())
    rules = group_stat(tr.withColumn("y", F.col("label").cast("double")), "y", ["prefix"], "mean")
    overall = tr.agg(F.avg(F.col("label").cast("double")).alias("value"))
    out = rule_fill(b.where(~is_train()).withColumn("target_mean", F.lit(None).cast("double")), "target_mean",
                    [(["prefix"], rules)], default=overall)
    return out.select("id", "prefix", F.round("target_mean", 6).alias("target_mean"))


@query("q_c13_scalar_cross_join", """
WITH s AS (SELECT median(amount_a) AS med, avg(CAST(label AS DOUBLE)) AS rate FROM base)
SELECT id, round(amount_a - med, 6) AS amount_dev, round(label - rate, 6) AS label_dev FROM base CROSS JOIN s""")
def q_c13(spark, sf):
    b = base(spark, sf)
    s = group_median(b, "amount_a", None, "med").crossJoin(
        b.agg(F.avg(F.col("label").cast("double")).alias("rate")))
    return with_scalars(b, s).select("id", F.round(F.col("amount_a") - F.col("med"), 6).alias("amount_dev"),
                                     F.round(F.col("label") - F.col("rate"), 6).alias("label_dev"))


@query("q_c14_fold_split", f"""
WITH f AS (SELECT id, label, {FOLD_SQL} AS fold FROM base),
k AS (SELECT DISTINCT fold AS k FROM f)
SELECT k.k AS fold, count(*) FILTER (WHERE f.fold <> k.k) AS n_train, count(*) FILTER (WHERE f.fold = k.k) AS n_val,
       CAST(sum(CASE WHEN f.fold = k.k THEN label ELSE 0 END) AS BIGINT) AS val_pos
FROM f CROSS JOIN k GROUP BY k.k""")
def q_c14(spark, sf):
    f = stratified_folds(base(spark, sf).select("id", "label"), "id", "label").persist()
    per = f.groupBy("fold").agg(F.count(F.lit(1)).alias("n_val"), F.sum("label").cast("long").alias("val_pos"))
    total = f.agg(F.count(F.lit(1)).alias("_n"))
    return with_scalars(per, total).select("fold", (F.col("_n") - F.col("n_val")).alias("n_train"), "n_val", "val_pos")
