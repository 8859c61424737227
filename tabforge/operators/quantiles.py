"""Exact, skew-safe group quantiles and modes.

Spark's exact ``percentile`` aggregate keeps a map of every distinct value of a
group inside one task; for a hot group over a continuous column that map is a
third of the data. The default ``bucketed`` strategy here stays exact without
that: it cuts the value axis into narrow order-preserving log-scale buckets,
counts rows per (group, bucket) (an aggregate), locates the bucket holding
each target rank, and ranks only the distinct values inside those buckets.
The result equals linear interpolation between order statistics (pandas
``quantile``, DuckDB ``quantile_cont``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.operators.common import as_list
from tabforge.session import cut_lineage


def _clean(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    v = F.col(value).cast("double")
    src = df.select(*keys, F.when(F.isnan(v), None).otherwise(v).alias("_v"))
    for k in keys:
        src = src.where(F.col(k).isNotNull())
    return src


def _names(probs: Sequence[float], names: Sequence[str] | None) -> list[str]:
    if names is not None:
        if len(names) != len(probs):
            raise ValueError("names and probs differ in length")
        return list(names)
    return [f"q{str(p).replace('.', '_')}" for p in probs]


# Bound on distinct (group, value) pairs under which Spark's exact
# ``percentile`` aggregate is safe: its per-group value map then holds at
# most this many entries even if one group owns all of them.
EXACT_MAP_BOUND = 1_000_000


def _choose(src: DataFrame, keys: list[str], strategy: str, bound: int) -> str:
    """``auto``: one HLL pass estimates distinct (group, value) pairs; under
    the bound (with a 10% margin for the estimate) the single-pass exact
    aggregate is used, otherwise the skew-safe bucketed path."""
    if strategy != "auto":
        return strategy
    est = src.agg(F.approx_count_distinct(F.struct(*keys, "_v"), 0.02).alias("n")).first()["n"]
    return "percentile" if est * 1.1 <= bound else "bucketed"


def group_quantiles(df: DataFrame, value: str, probs: Sequence[float], keys=None,
                    names: Sequence[str] | None = None, strategy: str = "auto",
                    n_buckets: int = 65536, accuracy: int = 10000,
                    exact_map_bound: int = EXACT_MAP_BOUND) -> DataFrame:
    """Per-group quantiles of ``value``; one output column per probability.

    strategy: ``bucketed`` (exact, skew-safe), ``percentile`` (Spark's exact
    aggregate; fine when distinct values per group are bounded), ``auto``
    (``percentile`` when an HLL estimate proves the distinct (group, value)
    pairs are under ``exact_map_bound``, else ``bucketed``) or ``approx``
    (``percentile_approx`` sketch with the given accuracy; constant memory).
    Groups whose values are all null appear with null quantiles; null keys
    are dropped (pandas groupby semantics).
    """
    keys = as_list(keys)
    names = _names(probs, names)
    probs = [float(p) for p in probs]
    src = _clean(df, value, keys)
    strategy = _choose(src, keys, strategy, exact_map_bound)
    if strategy == "percentile":
        # one map of values a group for all probabilities
        q = src.groupBy(*keys).agg(F.percentile("_v", F.array(*[F.lit(p) for p in probs])).alias("_q"))
        return cut_lineage(q.select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)]))
    if strategy == "approx":
        return src.groupBy(*keys).agg(
            *[F.percentile_approx("_v", p, accuracy).alias(n) for p, n in zip(probs, names)])
    if strategy != "bucketed":
        raise ValueError(f"unknown strategy {strategy}")
    return _bucketed(src, keys, probs, names, n_buckets, accuracy)


def value_bucket(v, per_octave: int = 65536):
    """Monotone bucket id of a double: 0 for zero, sign * (offset + floor(
    per_octave * log2|v|)) otherwise. Buckets are ~1e-5 relative wide for the
    default, so only point masses can be large, and those collapse to one
    (value, count) row before ranking. No sketch pass, no driver round trip."""
    lg = F.floor(F.log2(F.abs(v)) * F.lit(float(per_octave)))
    off = F.lit(1100 * per_octave).cast("long")
    end = F.lit(3300 * per_octave).cast("long")  # beyond every finite value; NaN sorts last, as in Spark
    return (F.when(F.isnan(v), end + 1).when(v == float("inf"), end).when(v == float("-inf"), -end)
            .when(v > 0, off + lg).when(v < 0, -(off + lg)).when(v == 0, F.lit(0))
            .cast("long"))


def _bucketed(src: DataFrame, keys: list[str], probs: list[float], names: list[str],
              n_buckets: int, accuracy: int) -> DataFrame:
    spark = src.sparkSession
    # 1. data-independent, order-preserving bucket of the value axis
    b = src.withColumn("_b", value_bucket(F.col("_v"), n_buckets))

    # 2. rows per (group, bucket): at most groups x buckets rows. One window
    # over it yields, per bucket, the rows before it and the group total, and
    # (first row per group) the group list, including all-null groups.
    counts = b.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_c"))
    wk = Window.partitionBy(*keys) if keys else Window.partitionBy()
    valued = F.when(F.col("_b").isNotNull(), F.col("_c")).otherwise(F.lit(0))
    bs = counts.select(
        *keys, "_b", "_c",
        F.coalesce(F.sum(valued).over(wk.orderBy(F.col("_b").asc_nulls_first())
                                      .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum(valued).over(wk).alias("_n"),
        F.row_number().over(wk.orderBy(F.col("_b").asc_nulls_first())).alias("_first"))
    groups = bs.where(F.col("_first") == 1).select(*keys, "_n")
    bs = bs.where(F.col("_b").isNotNull()).drop("_first", "_n")

    # 3. target order statistics: rank floor(p(n-1)) and ceil(p(n-1)), 0-based
    pr = spark.createDataFrame([(i, p) for i, p in enumerate(probs)], "_i int, _p double")
    t = groups.where(F.col("_n") > 0).crossJoin(F.broadcast(pr)).withColumn("_pos", F.col("_p") * (F.col("_n") - 1))
    t = t.select(*keys, "_i", "_pos",
                 F.explode(F.array(
                     F.struct(F.lit(0).alias("_w"), F.floor("_pos").alias("_r")),
                     F.struct(F.lit(1).alias("_w"), F.ceil("_pos").alias("_r")))).alias("_t"))
    t = t.select(*keys, "_i", "_pos", "_t._w", "_t._r")
    tb = (t.join(bs, keys) if keys else t.crossJoin(bs))
    tb = tb.where((F.col("_before") <= F.col("_r")) & (F.col("_r") < F.col("_before") + F.col("_c")))
    tb = tb.select(*keys, "_i", "_pos", "_w", "_r", "_b", "_before")

    # 4. rank distinct values inside the needed buckets only; ``need`` has at
    # most 2 x probs rows per group, and AQE broadcasts it at runtime when its
    # materialised size is under the broadcast threshold
    need = tb.select(*keys, "_b", "_before").distinct()
    vc = (b.join(need, keys + ["_b"]).groupBy(*keys, "_b", "_before", "_v")
           .agg(F.count(F.lit(1)).alias("_cv")))
    wb = Window.partitionBy(*keys, "_b").orderBy("_v")
    vc = vc.withColumn("_vb", F.col("_before") + F.coalesce(
        F.sum("_cv").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    hit = (tb.join(vc, keys + ["_b", "_before"])
             .where((F.col("_vb") <= F.col("_r")) & (F.col("_r") < F.col("_vb") + F.col("_cv")))
             .select(*keys, "_i", "_pos", "_w", "_v"))

    # 5. one aggregation: order statistics per probability, interpolated;
    # groups without values join in as empty rows (null quantiles)
    empty = groups.select(*keys, F.lit(None).cast("int").alias("_i"), F.lit(None).cast("double").alias("_pos"),
                          F.lit(None).cast("int").alias("_w"), F.lit(None).cast("double").alias("_v"))
    allr = hit.unionByName(empty) if keys else hit
    aggs = []
    for i in range(len(names)):
        aggs += [F.max(F.when((F.col("_i") == i) & (F.col("_w") == 0), F.col("_v"))).alias(f"_lo{i}"),
                 F.max(F.when((F.col("_i") == i) & (F.col("_w") == 1), F.col("_v"))).alias(f"_hi{i}"),
                 F.max(F.when(F.col("_i") == i, F.col("_pos"))).alias(f"_p{i}")]
    g = allr.groupBy(*keys).agg(*aggs)
    result = g.select(*keys, *[(F.col(f"_lo{i}") + (F.col(f"_p{i}") - F.floor(f"_p{i}"))
                                * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(n) for i, n in enumerate(names)])
    # The result is small (groups x probs): materialise it in the shared
    # checkpoint folder (one job; repeated subtrees share their exchanges) so
    # later plans do not carry and re-analyse this lineage.
    return cut_lineage(result)


def group_median(df: DataFrame, value: str, keys=None, name: str = "median", **kw) -> DataFrame:
    return group_quantiles(df, value, [0.5], keys, [name], **kw)


def group_mode(df: DataFrame, value: str, keys=None, name: str = "mode") -> DataFrame:
    """Most frequent non-null value per group; ties go to the smallest value.

    Counting by (group, value) is a partial aggregation spread over the value
    axis, and the pick is a plain ``min`` over structs, so a hot group never
    lands whole in one task.
    """
    keys = as_list(keys)
    src = df.select(*keys, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
    for k in keys:
        src = src.where(F.col(k).isNotNull())
    vc = src.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    best = vc.groupBy(*keys).agg(F.min(F.struct((-F.col("_c")).alias("nc"), F.col("_v").alias("v"))).alias("_m"))
    return best.select(*keys, F.col("_m.v").alias(name))


def _placeholder(dtype: str):
    if dtype == "string":
        return F.lit("")
    if dtype == "boolean":
        return F.lit(False)
    return F.lit(0).cast(dtype)


def group_quantiles_sets(df: DataFrame, value: str, probs: Sequence[float], key_sets: Sequence[Sequence[str]],
                         names: Sequence[str] | None = None, strategy: str = "auto",
                         n_buckets: int = 65536, accuracy: int = 10000,
                         exact_map_bound: int = EXACT_MAP_BOUND) -> list[DataFrame]:
    """Quantiles for several groupings at once (like GROUPING SETS): each row
    is expanded once per key set, tagged with the set's level, and a single
    bucketed computation runs over (level, keys). Returns one DataFrame per
    key set, in order."""
    key_sets = [list(k) for k in key_sets]
    names = _names(probs, names)
    if len(key_sets) <= 1 or strategy == "approx":
        return [group_quantiles(df, value, probs, ks, names, strategy, n_buckets, accuracy, exact_map_bound)
                for ks in key_sets]
    all_keys: list[str] = []
    for ks in key_sets:
        all_keys += [k for k in ks if k not in all_keys]
    types = dict(df.dtypes)
    structs = []
    for i, ks in enumerate(key_sets):
        ok = F.lit(True)
        for k in ks:
            ok = ok & F.col(k).isNotNull()
        structs.append(F.struct(F.lit(i).alias("_lvl"), ok.alias("_ok"),
                                *[(F.col(k) if k in ks else _placeholder(types[k])).alias(k) for k in all_keys]))
    x = (df.select(F.col(value).alias("_val"), F.explode(F.array(*structs)).alias("_s"))
           .select("_val", "_s.*").where(F.col("_ok")).drop("_ok"))
    res = group_quantiles(x, "_val", probs, ["_lvl"] + all_keys, names, strategy, n_buckets, accuracy,
                          exact_map_bound)
    return [res.where(F.col("_lvl") == i).select(*ks, *names) for i, ks in enumerate(key_sets)]
