"""Model-selection tables on per-(model, fold|seed) score tables: stability,
gaps, constrained / penalised / composite choice, expected external score,
target checks and diminishing returns of seed averaging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stability(fold_scores: DataFrame, model: str = "model", fold: str = "fold", score: str = "score") -> DataFrame:
    """mean/std(pop)/min/max/range and worst fold per model."""
    return fold_scores.groupBy(model).agg(
        F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"), F.min(score).alias("min"),
        F.max(score).alias("max"), (F.max(score) - F.min(score)).alias("range"),
        F.min(F.struct(F.col(score), F.col(fold))).getField(fold).alias("worst_fold"))


def with_gap(results: DataFrame, train: str = "train_score", cv: str = "cv_score") -> DataFrame:
    """gap = train - cv, gap% = 100 * gap / train."""
    g = F.col(train) - F.col(cv)
    return results.withColumns({"gap": g, "gap_pct": g * F.lit(100.0) / F.col(train)})


def constrained_best(results: DataFrame, model: str = "model", cv: str = "cv_score", gap: str = "gap",
                     max_gap: float = 0.02) -> DataFrame:
    """Best cv among models with gap < max_gap, else the smallest gap."""
    ok = results.where(F.col(gap) < max_gap)
    a = ok.agg(F.max(F.struct(F.col(cv), (-F.col(gap)).alias("ng"), F.col(model).alias("m"))).alias("b"))
    b = results.agg(F.min(F.struct(F.col(gap), (-F.col(cv)).alias("ncv"), F.col(model).alias("m"))).alias("b"))
    return a.crossJoin(b.withColumnRenamed("b", "fb")).select(
        F.coalesce(F.col("b.m"), F.col("fb.m")).alias("chosen"),
        F.when(F.col("b.m").isNotNull(), F.lit("within_gap")).otherwise(F.lit("min_gap")).alias("rule"))


def penalised_best(results: DataFrame, weight: float, model: str = "model", cv: str = "cv_score",
                   gap: str = "gap") -> DataFrame:
    """Arg-max of cv - weight * gap."""
    pen = F.col(cv) - F.lit(weight) * F.col(gap)
    return results.agg(F.max(F.struct(pen.alias("p"), F.col(model).alias("m"))).alias("b")).select(
        F.col("b.m").alias("chosen"), F.col("b.p").alias("penalised"))


def composite_score(oof: str, std: str, gap: str) -> F.Column:
    """0.5 * oof + 0.3 / (1 + std) + 0.2 / (1 + gap)."""
    return (F.lit(0.5) * F.col(oof) + F.lit(0.3) / (F.lit(1.0) + F.col(std))
            + F.lit(0.2) / (F.lit(1.0) + F.col(gap)))


def seed_count_curve(seeded: DataFrame, counts: Sequence[int], id_col: str = "id", seed: str = "seed",
                     proba: str = "proba", label: str = "label", keys: Sequence[str] = ("model",)) -> DataFrame:
    """For each n in ``counts`` average the first n seeds; accuracy,
    mean and max per-id spread, the gain over the previous n, and whether that
    gain fell below half the previous gain (the stopping rule)."""
    keys = list(keys)
    ns = seeded.sparkSession.createDataFrame([(int(n),) for n in counts], "n_seeds int")
    x = seeded.join(F.broadcast(ns), F.col(seed) < F.col("n_seeds"))
    per = x.groupBy(*keys, "n_seeds", id_col).agg(F.avg(proba).alias("_p"), F.stddev_pop(proba).alias("_sd"),
                                                   F.first(label).alias("_y"))
    g = per.groupBy(*keys, "n_seeds").agg(
        F.avg(((F.col("_p") >= 0.5).cast("int") == F.col("_y")).cast("double")).alias("accuracy"),
        F.avg("_sd").alias("mean_std"), F.max("_sd").alias("max_std"))
    w = Window.partitionBy(*keys).orderBy("n_seeds")
    g = g.withColumn("gain", F.col("accuracy") - F.lag("accuracy").over(w))
    return g.withColumn("diminishing", (F.col("gain") < F.lit(0.5) * F.lag("gain").over(w)).cast("int"))
