"""The skew-safe primitives must equal the plain single-task forms."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabforge.operators.quantiles import group_quantiles, group_mode
from tabforge.operators.ranking import bucketed_row_number, bucketed_running_sum, hex_prefix_bucket


def _data(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 else rnd.choice(["a", "b", "c", None])
        v = rnd.choice([0.0, 0.0, -3.5, 12.25]) if i % 7 == 0 else rnd.gauss(50, 30)
        if i % 11 == 0:
            v = None
        rows.append((i, g, v))
    return spark.createDataFrame(rows, "id int, g string, v double")


def test_bucketed_quantiles_equal_percentile(spark):
    df = _data(spark)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    names = [f"p{i}" for i in range(len(probs))]
    a = {r["g"]: [r[n] for n in names]
         for r in group_quantiles(df, "v", probs, "g", names, strategy="bucketed").collect()}
    b = {r["g"]: [r[n] for n in names] for r in group_quantiles(df, "v", probs, "g", names, strategy="percentile").collect()}
    assert set(a) == set(b) == {"hot", "a", "b", "c"}
    for k in a:
        for x, y in zip(a[k], b[k]):
            assert abs(x - y) < 1e-9 * max(1.0, abs(y))
    g = group_quantiles(df, "v", [0.5], None, ["m"], strategy="bucketed").first()["m"]
    h = group_quantiles(df, "v", [0.5], None, ["m"], strategy="percentile").first()["m"]
    assert abs(g - h) < 1e-9


def test_mode_matches_counts(spark):
    df = _data(spark).withColumn("r", F.round("v", 0))
    m = {r["g"]: r["mode"] for r in group_mode(df, "r", "g").collect()}
    counts = df.where("r IS NOT NULL AND g IS NOT NULL").groupBy("g", "r").count().collect()
    best = {}
    for r in counts:
        cur = best.get(r["g"])
        if cur is None or (r["count"], -r["r"]) > (cur[0], -cur[1]):
            best[r["g"]] = (r["count"], r["r"])
    assert m == {k: v[1] for k, v in best.items()}


def test_bucketed_row_number_equals_window(spark):
    df = _data(spark).withColumn("k", F.md5(F.col("id").cast("string"))).withColumn("lab", F.col("id") % 2)
    a = bucketed_row_number(df, ["lab"], [F.col("k"), F.col("id")], hex_prefix_bucket("k"), "rn")
    b = df.withColumn("rn2", F.row_number().over(Window.partitionBy("lab").orderBy("k", "id")))
    j = a.join(b.select("id", "rn2"), "id")
    assert j.where(F.col("rn") != F.col("rn2")).count() == 0 and j.count() == 3000


def test_bucketed_running_sum_equals_window(spark):
    df = _data(spark).where("v IS NOT NULL").groupBy("g", "v").agg(F.count(F.lit(1)).alias("c"))
    df = df.where("g IS NOT NULL")
    a = bucketed_running_sum(df, "g", "v", ["c"], descending=True)
    w = Window.partitionBy("g").orderBy(F.col("v").desc()).rowsBetween(Window.unboundedPreceding, 0)
    b = df.withColumn("ref", F.sum("c").over(w))
    j = a.join(b.select("g", "v", "ref"), ["g", "v"])
    assert j.where(F.col("cum_c") != F.col("ref")).count() == 0


def test_auto_strategy_switches_on_distinct_bound(spark):
    from tabforge.operators.quantiles import group_quantiles_sets
    df = _data(spark)
    sets = [["g"], []]
    low = group_quantiles_sets(df, "v", [0.5], sets, ["m"], strategy="auto", exact_map_bound=10)
    high = group_quantiles_sets(df, "v", [0.5], sets, ["m"], strategy="auto")
    for a, b in zip(low, high):
        ra = sorted((tuple(r) for r in a.collect()), key=str)
        rb = sorted((tuple(r) for r in b.collect()), key=str)
        assert len(ra) == len(rb)
        for x, y in zip(ra, rb):
            assert x[:-1] == y[:-1] and abs(x[-1] - y[-1]) < 1e-9


def test_approx_strategy_within_rank_error(spark):
    df = _data(spark).where("v IS NOT NULL AND g IS NOT NULL")
    approx = {r["g"]: r["m"] for r in group_quantiles(df, "v", [0.5], "g", ["m"], strategy="approx",
                                                       accuracy=1000).collect()}
    for g, m in approx.items():
        vals = sorted(r["v"] for r in df.where(F.col("g") == g).select("v").collect())
        rank = sum(1 for v in vals if v <= m) / len(vals)
        assert abs(rank - 0.5) <= 2.0 / 1000 + 1.0 / len(vals)
