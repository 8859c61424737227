"""Fold assignment (stratified, repeated, group, stratified group) and split.

Folds are a deterministic function of (seed, row key): rows are ranked within
their label by ``md5('<seed>:<id>')`` and dealt round-robin, which gives the
same class balance as a shuffled stratified split. Ranking uses the bucketed
row number, so no task ever holds a whole label class.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.operators.common import as_list
from tabforge.operators.ranking import bucketed_row_number, hex_prefix_bucket, range_row_number


def shuffle_key(id_col: str, seed) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def stratified_folds(df: DataFrame, id_col: str, label: str, k: int = 5, seed=42,
                     name: str = "fold") -> DataFrame:
    """fold = (rank within label by md5(seed:id)) mod k."""
    x = df.withColumn("_sk", shuffle_key(id_col, seed))
    x = bucketed_row_number(x, [label], [F.col("_sk"), F.col(id_col)], hex_prefix_bucket("_sk"), "_rn")
    return x.withColumn(name, ((F.col("_rn") - 1) % k).cast("int")).drop("_sk", "_rn")


def repeated_stratified_folds(df: DataFrame, id_col: str, label: str, k: int = 5, repeats: int = 3,
                              seed=42, name: str = "fold") -> DataFrame:
    """M2: one fold column per repeat, long form ``(.., repeat, fold)``."""
    x = df.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    x = x.withColumn("_sk", F.md5(F.concat(F.lit(f"{seed}-"), F.col("repeat").cast("string"),
                                           F.lit(":"), F.col(id_col).cast("string"))))
    x = bucketed_row_number(x, ["repeat", label], [F.col("_sk"), F.col(id_col)],
                            hex_prefix_bucket("_sk"), "_rn")
    return x.withColumn(name, ((F.col("_rn") - 1) % k).cast("int")).drop("_sk", "_rn")


def _snake(rank0: Column, k: int) -> Column:
    r = rank0 % F.lit(2 * k)
    return F.when(r < k, r).otherwise(F.lit(2 * k - 1) - r).cast("int")


def group_folds(df: DataFrame, group: str, k: int = 5, label: str | None = None,
                name: str = "fold") -> DataFrame:
    """M3/M4: whole groups per fold. Groups are ordered by (positives desc if
    ``label``), size desc, key and dealt in snake order (0..k-1, k-1..0, ...),
    balancing sizes (and positives). Null group keys form no group: their
    rows get a null fold. Returns ``df`` with the fold column."""
    aggs = [F.count(F.lit(1)).alias("_size")]
    if label:
        aggs.append(F.sum(F.col(label)).cast("long").alias("_pos"))
    g = df.where(F.col(group).isNotNull()).groupBy(group).agg(*aggs)
    order = ([F.col("_pos").desc()] if label else []) + [F.col("_size").desc(), F.col(group)]
    ranked = range_row_number(g, order, "_rn")
    folds = ranked.select(group, _snake(F.col("_rn") - 1, k).alias(name))
    return df.join(folds, group, "left")


def _deal(count: int, loads: list[int], step: int) -> list[int]:
    """How many of ``count`` equal groups each fold gets when they go one by one to the least load
    (ties: the first fold) and each adds ``step``; closed form for many, so that cost doesn't follow ``count``."""
    got = [0] * len(loads)
    if count > 16 * len(loads):
        low, high = min(loads), min(loads) + step * (count + 1)
        while low < high - 1:  # the highest level below which no more than count places lie
            mid = (low + high) // 2
            if sum(max(0, -((load - mid) // step)) for load in loads) <= count:
                low = mid
            else:
                high = mid
        got = [max(0, -((load - low) // step)) for load in loads]
    for _ in range(count - sum(got)):
        f = min(range(len(loads)), key=lambda i: (loads[i] + got[i] * step, i))
        got[f] += 1
    return got


def fold_quotas(signatures: Sequence[tuple[int, int, int]], k: int) -> list[list[int]]:
    """Groups of each signature (positives, negatives, groups) a fold gets, largest signatures first.

    A group goes to the fold where it adds least to the squared deviation of the
    class counts, each class measured by its total. Whole numbers: no ties by rounding.
    """
    total_pos = max(1, sum(p * c for p, _, c in signatures))
    total_neg = max(1, sum(n * c for _, n, c in signatures))
    weight_pos, weight_neg = total_neg ** 2, total_pos ** 2
    pos, neg, out = [0] * k, [0] * k, []
    for p, n, c in signatures:
        loads = [pos[f] * p * weight_pos + neg[f] * n * weight_neg for f in range(k)]
        got = _deal(c, loads, p * p * weight_pos + n * n * weight_neg)
        for f in range(k):
            pos[f] += got[f] * p
            neg[f] += got[f] * n
        out.append(got)
    return out


def balanced_group_folds(df: DataFrame, group: str, k: int = 5, label: str | None = None, name: str = "fold",
                         max_signatures: int = 100_000) -> DataFrame:
    """M3/M4: whole groups per fold, sizes (and class counts, with a 0/1 ``label``) as equal as greedy dealing makes them.

    Groups of equal class counts are interchangeable, so the greedy choice runs
    over their signatures (positives, negatives, number of groups) on the driver
    instead of over groups; each signature's groups are then numbered by key and
    cut by its quotas. Largest groups come first (size, then positives), so that
    smaller ones fill up what a huge group leaves uneven. Fold sizes differ by
    the largest group at most when there is no label. Signatures beyond the first
    ``max_signatures`` by size, which only hold smaller groups, deal their groups
    in turn from fold 0 on. A null label counts as negative; null group keys
    form no group: their rows get a null fold.
    """
    pos = F.sum(F.coalesce(F.col(label), F.lit(0))).cast("long") if label else F.lit(0).cast("long")
    g = (df.where(F.col(group).isNotNull()).groupBy(F.col(group).alias("_group"))
         .agg(F.count(F.lit(1)).alias("_size"), pos.alias("_pos")))
    g = range_row_number(g, [F.col("_group")], "_rn", partition=["_size", "_pos"])
    shapes = (g.groupBy("_size", "_pos").agg(F.count(F.lit(1)).alias("c"))
              .orderBy(F.col("_size").desc(), F.col("_pos").desc()).limit(max_signatures).collect())
    quotas = fold_quotas([(r["_pos"], r["_size"] - r["_pos"], r["c"]) for r in shapes], k)
    rows = [(r["_size"], r["_pos"], np.cumsum(q).tolist()) for r, q in zip(shapes, quotas, strict=True)]
    ends = df.sparkSession.createDataFrame(rows, "_s long, _p long, _ends array<long>")
    x = g.join(F.broadcast(ends), (F.col("_size") == F.col("_s")) & (F.col("_pos") == F.col("_p")), "left")
    dealt = F.size(F.filter("_ends", lambda e: e < F.col("_rn")))
    folds = x.select("_group", F.when(F.col("_ends").isNull(), (F.col("_rn") - 1) % k).otherwise(dealt).cast("int").alias(name))
    return df.join(folds, F.col(group) == F.col("_group"), "left").drop("_group")


def group_profile(df: DataFrame, group: str) -> DataFrame:
    """M5: histogram of group sizes ``(size, n_groups, n_rows)``."""
    sizes = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("size").agg(F.count(F.lit(1)).alias("n_groups"),
                                     F.sum("size").cast("long").alias("n_rows"))


def fold_split(df: DataFrame, fold: int, col: str = "fold") -> tuple[DataFrame, DataFrame]:
    """C14: (train, validation) of one fold; a filter, no join."""
    return df.where(F.col(col) != fold), df.where(F.col(col) == fold)


def fold_balance(df: DataFrame, label: str, col: str = "fold", keys=None) -> DataFrame:
    """Per-fold size and positive rate (the balance report of M4)."""
    keys = as_list(keys)
    return df.groupBy(*keys, col).agg(F.count(F.lit(1)).alias("n"),
                                      F.sum(label).cast("long").alias("positives"))
