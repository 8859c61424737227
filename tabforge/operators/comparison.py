"""Comparisons of two columns, two frames and two blocks of features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.operators.common import safe_corr
from tabforge.operators.impute import missing_flags
from tabforge.operators.joins import column_pairs
from tabforge.operators.profile import missing_impact


def block_correlations(df: DataFrame, blocks: dict[str, Sequence[str]], min_abs: float = 0.3, digits: int = 6) -> DataFrame:
    """K3: pairs of features with |r| above ``min_abs``: (block1, block2, f1, f2, corr), within and between named
    blocks. One aggregation over pairwise complete rows; a constant feature has no correlation and no row."""
    of = {c: b for b, cols in blocks.items() for c in cols}
    pairs = column_pairs(list(of))
    wide = df.agg(*[safe_corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.explode(F.array(*[F.struct(F.lit(of[a]).alias("block1"), F.lit(of[b]).alias("block2"), F.lit(a).alias("f1"), F.lit(b).alias("f2"),
                                        F.round(f"r{i}", digits).alias("corr"), F.abs(f"r{i}").alias("_abs")) for i, (a, b) in enumerate(pairs)]))
    return wide.select(rows.alias("s")).select("s.*").where(F.col("_abs") > min_abs).drop("_abs")


def mean_std_differences(df: DataFrame, cols: Sequence[str], first: Column, second: Column, limit: float = 0.1, digits: int = 6) -> DataFrame:
    """K6: mean and sample deviation of the rows of each side, their absolute differences, and ``shifted`` where the
    means differ by more than ``limit`` in the feature's own unit. One aggregation."""
    aggs = []
    for i, c in enumerate(cols):
        for side, cond in (("a", first), ("b", second)):
            x = F.when(cond, F.col(c).cast("double"))
            aggs += [F.avg(x).alias(f"m{side}{i}"), F.stddev_samp(x).alias(f"s{side}{i}")]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), *[F.col(f"{k}{i}").alias(k) for k in ("ma", "mb", "sa", "sb")])
                               for i, c in enumerate(cols)]))
    x = wide.select(rows.alias("s")).select("s.*")
    gap = F.abs(F.col("ma") - F.col("mb"))
    return x.select("feature", F.round("ma", digits).alias("mean_first"), F.round("mb", digits).alias("mean_second"),
                    F.round(gap, digits).alias("mean_diff"), F.round("sa", digits).alias("std_first"), F.round("sb", digits).alias("std_second"),
                    F.round(F.abs(F.col("sa") - F.col("sb")), digits).alias("std_diff"),
                    F.coalesce(gap > limit, F.lit(False)).cast("int").alias("shifted"))


def agreement(df: DataFrame, a: str, b: str, label: str, digits: int = 6) -> DataFrame:
    """K8: rows where ``a`` equals, lies below and lies above ``b``: (pattern, n, share of comparable rows, label
    rate); the share of ``equal`` is the match rate. Rows with a null on either side are not comparable."""
    d = F.col(a) - F.col(b)
    pattern = F.when(d == 0, "equal").when(d < 0, "below").otherwise("above")
    total = df.where(d.isNotNull()).agg(F.count(F.lit(1)).alias("_total"))
    g = (df.where(d.isNotNull()).groupBy(pattern.alias("pattern"))
         .agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("_rate")))
    return g.crossJoin(F.broadcast(total)).select("pattern", "n", F.round(F.col("n") / F.col("_total"), digits).alias("share"),
                                                  F.round("_rate", digits).alias("rate"))


def top_differences(df: DataFrame, id_col: str, a: str, b: str, n: int, keep: Sequence[str] = ()) -> DataFrame:
    """K8/K9: the ``n`` rows whose ``a`` and ``b`` differ most (ties: smaller id), with the signed difference and position."""
    x = df.withColumn("diff", F.col(a) - F.col(b)).where("diff IS NOT NULL AND diff <> 0")
    top = x.orderBy(F.abs("diff").desc(), id_col).limit(n).select(id_col, a, b, "diff", *keep)
    # n rows: their positions come from one sorted list
    listed = top.agg(F.sort_array(F.collect_list(F.struct((-F.abs("diff")).alias("_k"), id_col, a, b, "diff", *keep))).alias("_all"))
    return listed.select(F.posexplode("_all").alias("_at", "_r")).select((F.col("_at") + 1).cast("long").alias("pos"), "_r.*").drop("_k")


def selected_missing_flags(train: DataFrame, others: Sequence[DataFrame], cols: Sequence[str], label: str, min_diff: float = 0.05,
                           alpha: float = 0.05, suffix: str = "_missing") -> tuple[list[str], list[DataFrame]]:
    """Names of the missing flags worth having, judged on ``train`` (rates differ by more than ``min_diff`` or
    p below ``alpha``), and ``train`` and ``others`` with exactly those added. A column missing nowhere or everywhere
    is not judged. The list on the driver has at most one name a column."""
    impact = missing_impact(train, cols, label).where((F.abs("diff") > min_diff) | (F.col("p_value") < alpha))
    chosen = {r["column"] for r in impact.where("n_present > 0").select("column").collect()}
    kept = [c for c in cols if c in chosen]
    return [f"{c}{suffix}" for c in kept], [missing_flags(df, kept, suffix) if kept else df for df in (train, *others)]
