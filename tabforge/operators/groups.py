"""Group-by operators: rate tables, sizes, value counts, profiles, cross-tabs,
describe, group transforms and set operations on small result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.operators.common import as_list
from tabforge.operators.quantiles import group_quantiles
from tabforge.session import cut_lineage


def _drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def group_rate(df: DataFrame, keys, label: str, digits: int = 6) -> DataFrame:
    """Count, positives and (half-even rounded) rate of a 0/1 label."""
    keys = as_list(keys)
    return _drop_null_keys(df, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(label)).cast("long").alias("positives"),
        F.bround(F.avg(F.col(label).cast("double")), digits).alias("rate"))


def group_size(df: DataFrame, keys, name: str = "n") -> DataFrame:
    """``size()`` / ``value_counts()`` (null keys dropped)."""
    keys = as_list(keys)
    return _drop_null_keys(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def value_share(df: DataFrame, key: str, digits: int = 6) -> DataFrame:
    """D3: normalised value counts; the total is a 1-row aggregate."""
    counts = group_size(df, key)
    total = counts.agg(F.sum("n").alias("_total"))
    return (counts.crossJoin(F.broadcast(total))
            .select(key, "n", F.bround(F.col("n") / F.col("_total"), digits).alias("share")))


def describe(df: DataFrame, cols: Sequence[str], digits: int = 6, strategy: str = "auto") -> DataFrame:
    """count/mean/std/min/quartiles/max per column, exact quartiles, long form. The columns are
    written once: every quantile reads them several times, and must not compute ``df`` anew for it."""
    df = cut_lineage(df.select(*cols))
    moments = df.agg(*[f.alias(f"{name}{i}") for i, c in enumerate(cols) for name, f in (
        ("count", F.count(c)), ("mean", F.avg(c)), ("std", F.stddev_samp(c)), ("min", F.min(c).cast("double")), ("max", F.max(c).cast("double")))])
    parts = []
    for i, c in enumerate(cols):
        mom = moments.select(*[F.col(f"{x}{i}").alias(x) for x in ("count", "mean", "std", "min", "max")])
        q = group_quantiles(df, c, [0.25, 0.5, 0.75], None, ["p25", "p50", "p75"], strategy=strategy)
        parts.append(mom.crossJoin(q).select(F.lit(c).alias("column"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("column", "count", *[F.round(F.col(x), digits).alias(x)
                                           for x in ["mean", "std", "min", "p25", "p50", "p75", "max"]])


def non_null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One pass, long form (column, dtype, non_null, rows)."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in cols])
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                                            F.col(c).alias("non_null")) for c in cols]))
    return wide.select(F.col("_rows").alias("rows"), stacked.alias("s")).select("s.*", "rows")


def crosstab(df: DataFrame, row: str, col: str, values: Sequence | None = None,
             agg: Column | None = None, margins: bool = False, margin_name: str = "All") -> DataFrame:
    """Long cross-tab ``(row, col, value)``; margins via cube.

    Kept long (not pivoted) so its width does not depend on the data; pass
    ``values`` to pivot to a fixed column list with ``pivot_wide``.
    """
    src = _drop_null_keys(df, [row, col])
    measure = (agg if agg is not None else F.count(F.lit(1))).alias("value")
    if not margins:
        return src.groupBy(row, col).agg(measure)
    g = src.cube(row, col).agg(measure, F.grouping(row).alias("_gr"), F.grouping(col).alias("_gc"))
    return g.select(
        F.when(F.col("_gr") == 1, F.lit(margin_name)).otherwise(F.col(row).cast("string")).alias(row),
        F.when(F.col("_gc") == 1, F.lit(margin_name)).otherwise(F.col(col).cast("string")).alias(col),
        "value")


def pivot_wide(long_df: DataFrame, row: str, col: str, values: Sequence, value: str = "value",
               fill=None) -> DataFrame:
    """Pivot a long table to a fixed, given column list."""
    out = long_df.groupBy(row).pivot(col, list(values)).agg(F.first(value))
    return out.fillna(fill) if fill is not None else out
