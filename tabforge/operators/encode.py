"""Category encoders and feature constructors.

Learnt encoders keep their state as a small DataFrame (value -> code) or a
bounded category list, fitted on the train frame only and applied to any
frame, so train and serve share one schema.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.operators.common import checked_broadcast, flag
from tabforge.operators.ranking import range_row_number


@dataclass
class LabelEncoderModel:
    col: str
    codes: DataFrame  # (col, code)
    out: str
    on_unseen: str = "error"

    def transform(self, df: DataFrame) -> DataFrame:
        j = df.join(checked_broadcast(self.codes.withColumnRenamed("code", self.out)), self.col, "left")
        if self.on_unseen == "error":
            bad = F.col(self.col).isNotNull() & F.col(self.out).isNull()
            j = j.withColumn(self.out, F.when(bad, F.raise_error(
                F.concat(F.lit(f"unseen value in {self.col}: "), F.col(self.col).cast("string"))))
                .otherwise(F.col(self.out)))
        return j


def label_encoder(df: DataFrame, col: str, out: str | None = None, on_unseen: str = "error") -> LabelEncoderModel:
    """Codes 0..k-1 in sorted value order, learnt from ``df``.

    The distinct values are ranked in ranges cut by sampled splitters, so that
    no task sorts them all, whatever prefix they share; the codes are written.
    """
    d = df.where(F.col(col).isNotNull()).select(col).distinct()
    ranked = range_row_number(d, [F.col(col)], "_rn")
    codes = ranked.select(col, (F.col("_rn") - 1).cast("int").alias("code"))
    return LabelEncoderModel(col, codes, out or f"{col}_code", on_unseen)


@dataclass
class OneHotModel:
    col: str
    categories: list
    drop_first: bool = True
    prefix: str | None = None

    @property
    def columns(self) -> list[str]:
        cats = self.categories[1:] if self.drop_first else self.categories
        p = self.prefix or self.col
        return [f"{p}_{c}" for c in cats]

    def transform(self, df: DataFrame) -> DataFrame:
        """One flag per kept category; categories absent from ``df`` still
        get their (all-zero) column, unseen values give all zeros."""
        cats = self.categories[1:] if self.drop_first else self.categories
        return df.withColumns({name: flag(F.col(self.col) == F.lit(c)) for name, c in zip(self.columns, cats)})


def one_hot(df: DataFrame, col: str, drop_first: bool = True, max_categories: int = 1000,
            prefix: str | None = None) -> OneHotModel:
    """Fit the sorted category list; one column a category, so at most ``max_categories`` (``sparse_one_hot`` has no bound)."""
    cats = [r[0] for r in df.where(F.col(col).isNotNull()).select(col).distinct()
            .orderBy(col).limit(max_categories + 1).collect()]
    if len(cats) > max_categories:
        raise ValueError(f"{col} has more than {max_categories} categories")
    return OneHotModel(col, cats, drop_first, prefix)


@dataclass
class SparseOneHotModel:
    """One-hot codes of any number of categories; the dictionary stays distributed."""
    col: str
    slots: DataFrame  # (col, slot): position of the category's flag, null for the one dropped
    n_slots: int

    def transform(self, df: DataFrame, out: str | None = None) -> DataFrame:
        """Adds the position of the row's only 1 among ``n_slots`` flags; null (all flags 0) for
        null, dropped and unseen values. Train and serve frames share the positions."""
        out = out or f"{self.col}_slot"
        known = self.slots.select(F.col(self.col).alias("_category"), F.col("slot").alias(out))
        return df.join(known, F.col(self.col) == F.col("_category"), "left").drop("_category")

    def long(self, df: DataFrame, id_col: str) -> DataFrame:
        """(id, slot, value): the flags that are 1."""
        x = self.transform(df.select(id_col, self.col), "slot").where(F.col("slot").isNotNull())
        return x.select(id_col, "slot", F.lit(1.0).alias("value"))

    def vectors(self, df: DataFrame, out: str | None = None) -> DataFrame:
        """Adds a sparse vector of ``n_slots`` entries for Spark ML estimators; all zeros where no flag is 1."""
        out = out or f"{self.col}_vector"
        x = self.transform(df, "_slot").withColumn("_slot", F.coalesce("_slot", F.lit(self.n_slots)).cast("double"))
        # index n_slots stands for "none": the encoder's last category, which it leaves out
        sizes = df.sparkSession.range(self.n_slots, self.n_slots + 1).select(F.col("id").cast("double").alias("_slot"))
        return OneHotEncoder(inputCol="_slot", outputCol=out, dropLast=True).fit(sizes).transform(x).drop("_slot")


def sparse_one_hot(df: DataFrame, col: str, drop_first: bool = True) -> SparseOneHotModel:
    """I3/I14 without a bound on categories: positions follow the sorted values, learnt from ``df``."""
    codes = label_encoder(df, col).codes
    drop = 1 if drop_first else 0
    slots = codes.select(col, F.when(F.col("code") >= drop, F.col("code") - drop).cast("int").alias("slot"))
    return SparseOneHotModel(col, slots, max(0, codes.count() - drop))


def one_hot_fixed(col: str, values: Sequence, prefix: str | None = None) -> dict[str, Column]:
    """I4: flag columns for a fixed value list."""
    p = prefix or col
    return {f"{p}_{v}": flag(F.col(col) == F.lit(v)) for v in values}


def rare_bucket(df: DataFrame, col: str, min_count: int = 10, out: str | None = None,
                other: str = "Other", unknown: str = "Unknown", source: DataFrame | None = None) -> DataFrame:
    """Values seen fewer than ``min_count`` times -> ``other``; null -> ``unknown``."""
    out = out or col
    src = source if source is not None else df
    counts = src.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_cnt"))
    j = df.join(checked_broadcast(counts), col, "left")
    return j.withColumn(out, F.when(F.col(col).isNull(), F.lit(unknown))
                        .when(F.coalesce(F.col("_cnt"), F.lit(0)) < min_count, F.lit(other))
                        .otherwise(F.col(col))).drop("_cnt")


def family_features(a: str, b: str, size: str = "family_size", alone: str = "is_alone",
                    small: str = "small_family", lo: int = 2, hi: int = 4) -> dict[str, Column]:
    """size = a + b + 1, alone = size == 1, small = lo <= size <= hi."""
    s = F.col(a) + F.col(b) + 1
    return {size: s, alone: (s == 1).cast("int"), small: flag(s.between(lo, hi))}


def target_mean_oof(df: DataFrame, key: str, label: str, fold: str, out: str = "target_mean",
                    prior: float | None = None) -> DataFrame:
    """I10 (fold-safe): mean label of the key over the *other* folds,
    (sum - sum_f) / (n - n_f); keys unseen outside the fold get the overall
    mean of the other folds (or ``prior``)."""
    # one pass over df: every other total is derived from this small table
    per_all = df.groupBy(key, fold).agg(F.sum(label).alias("_sf"), F.count(F.lit(1)).alias("_nf")).persist()
    per = per_all.where(F.col(key).isNotNull())
    tot = per.groupBy(key).agg(F.sum("_sf").alias("_s"), F.sum("_nf").alias("_n"))
    fold_tot = per_all.groupBy(fold).agg(F.sum("_sf").alias("_fs"), F.sum("_nf").alias("_fn"))
    all_tot = per_all.agg(F.sum("_sf").alias("_as"), F.sum("_nf").alias("_an"))
    stats = per.join(tot, key)
    j = (df.join(checked_broadcast(stats), [key, fold], "left")
           .join(F.broadcast(fold_tot), fold, "left").crossJoin(F.broadcast(all_tot)))
    other_n = F.col("_n") - F.col("_nf")
    te = F.when(other_n > 0, (F.col("_s") - F.col("_sf")) / other_n)
    fallback = F.lit(prior) if prior is not None else (F.col("_as") - F.col("_fs")) / (F.col("_an") - F.col("_fn"))
    return j.withColumn(out, F.coalesce(te, fallback).cast("double")).drop(
        "_sf", "_nf", "_s", "_n", "_fs", "_fn", "_as", "_an")


@dataclass
class ScalerModel:
    stats: DataFrame  # one row: <c>_mean, <c>_std for each column
    cols: list[str]
    suffix: str = ""

    def transform(self, df: DataFrame) -> DataFrame:
        j = df.crossJoin(F.broadcast(self.stats))
        j = j.withColumns({f"{c}{self.suffix}": (F.col(c) - F.col(f"_{c}_mean")) / F.col(f"_{c}_std")
                           for c in self.cols})
        return j.drop(*[f"_{c}_mean" for c in self.cols], *[f"_{c}_std" for c in self.cols])


def standard_scaler(df: DataFrame, cols: Sequence[str], suffix: str = "") -> ScalerModel:
    """Mean and *population* std learnt on ``df`` (1-row table)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"_{c}_mean"), F.stddev_pop(c).alias(f"_{c}_std")]
    return ScalerModel(df.agg(*aggs), list(cols), suffix)


def gated(value: str | Column, cls: str, level) -> Column:
    """Value when class == level else 0."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(F.col(cls) == F.lit(level), v).otherwise(F.lit(0))
