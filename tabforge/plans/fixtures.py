"""Derived views over the driver tables (see FIXTURES.md section 3).

``base`` plays the role of the raw input frame (class, category, nullable
amounts, name with a title, shared key text, sparse unit code, label, origin).
``scores`` plays the role of an out-of-fold prediction table of three models.
Both exist twice: as DataFrame plans (used by the library queries) and as SQL
text (used by the DuckDB oracle). The two were checked to give equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with injected nulls and zeros.

    nation (25 rows) and region (5 rows) are fixed-size dimension tables, so
    they are broadcast; customer grows with the data and is left to the
    planner (size-checked broadcast threshold or sort-merge join).
    """
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    dim = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(F.broadcast(dim), F.col("c_nationkey") == F.col("n_nationkey")))
    k = F.col("o_orderkey")
    ck = F.col("o_custkey")
    title = (F.when(k % 12 == 0, ", Mrs. A").when(k % 12 == 1, ", Miss. B")
             .when(k % 12 == 2, ", Master. C").when(k % 12 == 3, ", Dr. D")
             .when(k % 12 == 4, ", Mlle. E").when(k % 12 == 5, ", Countess. F")
             .when(k % 12 == 6, " no title").otherwise(", Mr. G"))
    cks = ck.cast("string")
    ticket = (F.when(ck % 6 == 0, cks).when(ck % 6 == 1, F.concat(F.lit("PC "), cks))
              .when(ck % 6 == 2, F.concat(F.lit("SOTON/O.Q. "), cks))
              .when(ck % 6 == 3, F.concat(F.lit("A/5. "), cks))
              .when(ck % 6 == 4, F.concat(F.lit("W./C. "), cks)).otherwise(F.lit("LINE")))
    unit = F.when(k % 4 != 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("ABCDEFG").substr((k % 7).cast("int") + 1, F.lit(1)),
                 (ck % 100).cast("string")))
    return j.select(
        k.alias("id"),
        ck.alias("group_key"),
        F.col("o_orderpriority").alias("klass"),
        F.col("o_orderstatus").alias("category"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("region"),
        F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal")).alias("amount_a"),
        F.when(k % 11 == 0, F.lit(None).cast("double")).when(k % 17 == 0, F.lit(0.0))
         .otherwise(F.col("o_totalprice")).alias("amount_b"),
        F.concat(F.lit("Person"), cks, title).alias("full_name"),
        ticket.alias("ticket"),
        unit.alias("unit_code"),
        (k % 4).cast("int").alias("n_sib"),
        (k % 3).cast("int").alias("n_par"),
        F.when(F.col("o_totalprice") > 250000, 1).otherwise(0).alias("label"),
        F.when(k % 10 < 7, "train").otherwise("serve").alias("origin"),
    )


# Fixed values of the score fixture: (model name, price weight, id multiplier).
SCORE_MODELS = [("m1", 0.6, 37), ("m2", 0.5, 41), ("m3", 0.4, 53)]


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long prediction table ``(id, model, label, proba)``.

    One scan of orders, fanned out to the three models with an explode, rather
    than a union of three scans.
    """
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    spec = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(w).alias("w"), F.lit(mult).alias("mult"))
                     for m, w, mult in SCORE_MODELS])
    x = o.select("o_orderkey", "o_totalprice", F.explode(spec).alias("s"))
    w = F.col("s.w")
    noise = ((F.col("o_orderkey") * F.col("s.mult") + 11) % 1000).cast("double") / F.lit(1000.0)
    raw = w * F.col("o_totalprice") / F.lit(510000.0) + (F.lit(1.0) - w) * noise
    proba = F.floor(F.lit(1000.0) * F.least(F.lit(1.0), raw)).cast("double") / F.lit(1000.0)
    return x.select(
        F.col("o_orderkey").alias("id"),
        F.col("s.model").alias("model"),
        F.when(F.col("o_totalprice") > 250000, 1).otherwise(0).alias("label"),
        proba.alias("proba"),
    )


BASE_SQL = """
SELECT o_orderkey AS id, o_custkey AS group_key, o_orderpriority AS klass, o_orderstatus AS category,
 CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE r_name END AS region,
 CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE c_acctbal END AS amount_a,
 CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice END AS amount_b,
 concat('Person', CAST(o_custkey AS VARCHAR), CASE o_orderkey % 12 WHEN 0 THEN ', Mrs. A' WHEN 1 THEN ', Miss. B' WHEN 2 THEN ', Master. C'
   WHEN 3 THEN ', Dr. D' WHEN 4 THEN ', Mlle. E' WHEN 5 THEN ', Countess. F' WHEN 6 THEN ' no title' ELSE ', Mr. G' END) AS full_name,
 CASE o_custkey % 6 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN concat('PC ', CAST(o_custkey AS VARCHAR)) WHEN 2 THEN concat('SOTON/O.Q. ', CAST(o_custkey AS VARCHAR))
   WHEN 3 THEN concat('A/5. ', CAST(o_custkey AS VARCHAR)) WHEN 4 THEN concat('W./C. ', CAST(o_custkey AS VARCHAR)) ELSE 'LINE' END AS ticket,
 CASE WHEN o_orderkey % 4 <> 0 THEN NULL ELSE concat(substr('ABCDEFG', CAST(o_orderkey % 7 AS INT) + 1, 1), CAST(o_custkey % 100 AS VARCHAR)) END AS unit_code,
 CAST(o_orderkey % 4 AS INT) AS n_sib, CAST(o_orderkey % 3 AS INT) AS n_par,
 CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS label,
 CASE WHEN o_orderkey % 10 < 7 THEN 'train' ELSE 'serve' END AS origin
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

SCORES_SQL = " UNION ALL ".join(
    f"""SELECT o_orderkey AS id, '{m}' AS model, CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS label,
 CAST(floor(1000 * least(CAST(1 AS DOUBLE), CAST({w} AS DOUBLE) * o_totalprice / CAST(510000 AS DOUBLE)
 + (1 - CAST({w} AS DOUBLE)) * CAST((o_orderkey * {mult} + 11) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE))) AS DOUBLE) / 1000 AS proba
 FROM orders""" for m, w, mult in SCORE_MODELS)


# Number of seed replicates of the seeded score fixture.
N_SEEDS = 3


def seeded_scores(spark: SparkSession, sf_dir: str, n_seeds: int = N_SEEDS) -> DataFrame:
    """``scores`` replicated over seeds with a deterministic +-2/1000 jitter,
    playing the role of per-seed out-of-fold predictions."""
    s = scores(spark, sf_dir).withColumn("seed", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_seeds - 1).cast("long"))))
    jit = ((F.col("id") * (F.col("seed") + 3)) % 5 - 2).cast("double") / F.lit(1000.0)
    return s.withColumn("proba", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("proba") + jit)))


SEEDED_SQL = f"""SELECT id, model, label, seed,
 least(CAST(1 AS DOUBLE), greatest(CAST(0 AS DOUBLE), proba + CAST((id * (seed + 3)) % 5 - 2 AS DOUBLE) / CAST(1000 AS DOUBLE))) AS proba
 FROM scores CROSS JOIN (SELECT unnest(range(0, {N_SEEDS})) AS seed)"""
