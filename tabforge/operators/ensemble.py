"""Ensembles, calibration summaries and diversity on the long prediction
table ``(id, model[, seed], label, proba[, pred])``. Every operator is a
group-by over ``id`` (or over model pairs joined on ``id``), so the work is
spread by id and each id only ever meets its own k model rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.operators.common import checked_broadcast, safe_corr

from tabforge.operators.common import as_list
from tabforge.operators.joins import pair_join


def with_pred(df: DataFrame, proba: str = "proba", threshold: float = 0.5, inclusive: bool = True,
              out: str = "pred") -> DataFrame:
    """Apply a threshold (>= by default, > when ``inclusive=False``)."""
    c = (F.col(proba) >= threshold) if inclusive else (F.col(proba) > threshold)
    return df.withColumn(out, c.cast("int"))


def label_mean_vote(df: DataFrame, id_col: str = "id", pred: str = "pred", keys=None) -> DataFrame:
    """Half-even rounded mean of member labels (0.5 -> 0)."""
    keys = as_list(keys)
    return df.groupBy(*keys, id_col).agg(F.bround(F.avg(F.col(pred).cast("double")), 0).cast("int").alias("vote"))


def hard_vote(df: DataFrame, id_col: str = "id", pred: str = "pred", keys=None) -> DataFrame:
    """Strict majority of labels; a tie goes to the lower class."""
    keys = as_list(keys)
    return df.groupBy(*keys, id_col).agg((F.avg(F.col(pred).cast("double")) > 0.5).cast("int").alias("vote"))


def soft_vote(df: DataFrame, id_col: str = "id", proba: str = "proba", keys=None, threshold: float = 0.5,
              inclusive: bool = True, weights: DataFrame | None = None, model_col: str = "model",
              only_weighted: bool = False) -> DataFrame:
    """(weighted) mean probability per id and its thresholded label.
    ``weights`` is a small ``(model, weight)`` table. A model without a weight
    is an error, unless ``only_weighted`` selects the models that have one."""
    keys = as_list(keys)
    x = df
    if weights is not None:
        x = x.join(checked_broadcast(weights), model_col, "inner" if only_weighted else "left")
        weight = F.coalesce("weight", F.raise_error(F.concat(F.lit("no weight for model "), F.col(model_col).cast("string"))).cast("double"))
        p = F.sum(weight * F.col(proba)) / F.sum(weight)
    else:
        p = F.avg(proba)
    g = x.groupBy(*keys, id_col).agg(p.alias("proba"))
    c = (F.col("proba") >= threshold) if inclusive else (F.col("proba") > threshold)
    return g.withColumn("vote", c.cast("int"))


def normalised_weights(scores: DataFrame, model_col: str, score_col: str, top_k: int | None = None) -> DataFrame:
    """weight = score / sum(score) over all (or the top-k) models; the
    input is a per-model result table (bounded by the number of models)."""
    x = scores
    if top_k is not None:
        w = Window.orderBy(F.col(score_col).desc(), F.col(model_col))
        x = x.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= top_k).drop("_rk")
    tot = x.agg(F.sum(score_col).alias("_tot"))
    return x.crossJoin(tot).select(model_col, (F.col(score_col) / F.col("_tot")).alias("weight"))


def fixed_weights(spark, weights: Mapping[str, float], model_col: str = "model") -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in weights.items()], f"{model_col} string, weight double")


def seed_average(df: DataFrame, id_col: str = "id", model_col: str = "model", proba: str = "proba") -> DataFrame:
    """Mean over seeds (and folds) per (model, id), then over models."""
    per_model = df.groupBy(model_col, id_col).agg(F.avg(proba).alias("_pm"))
    return per_model.groupBy(id_col).agg(F.avg("_pm").alias("proba"))


def prediction_spread(df: DataFrame, over: str, id_col: str = "id", proba: str = "proba", keys=None) -> DataFrame:
    """Population std of the probability over ``over`` per id, then its
    mean and max (per ``keys``)."""
    keys = as_list(keys)
    s = df.groupBy(*keys, id_col).agg(F.stddev_pop(proba).alias("_sd"))
    return s.groupBy(*keys).agg(F.avg("_sd").alias("mean_std"), F.max("_sd").alias("max_std"))


def pair_diversity(df: DataFrame, id_col: str = "id", model_col: str = "model", pred: str = "pred",
                   label: str = "label", items: Sequence[str] | None = None) -> DataFrame:
    """Per unordered model pair: agreement, both right/wrong, only
    one right, Q statistic (null when ad + bc = 0), prediction correlation,
    diversity = 1 - corr."""
    p = pair_join(df.withColumn("_ok", (F.col(pred) == F.col(label)).cast("int")), id_col, model_col,
                  [pred, "_ok"], items)
    a = F.sum(F.when((F.col("_ok_a") == 1) & (F.col("_ok_b") == 1), 1).otherwise(0))
    d = F.sum(F.when((F.col("_ok_a") == 0) & (F.col("_ok_b") == 0), 1).otherwise(0))
    b = F.sum(F.when((F.col("_ok_a") == 1) & (F.col("_ok_b") == 0), 1).otherwise(0))
    c = F.sum(F.when((F.col("_ok_a") == 0) & (F.col("_ok_b") == 1), 1).otherwise(0))
    g = p.groupBy("item_a", "item_b").agg(
        F.avg((F.col(f"{pred}_a") == F.col(f"{pred}_b")).cast("double")).alias("agreement"),
        a.alias("both_right"), d.alias("both_wrong"), b.alias("only_a"), c.alias("only_b"),
        safe_corr(F.col(f"{pred}_a").cast("double"), F.col(f"{pred}_b").cast("double")).alias("corr"))
    ad = F.col("both_right").cast("double") * F.col("both_wrong")
    bc = F.col("only_a").cast("double") * F.col("only_b")
    return g.select("item_a", "item_b", "agreement", F.col("both_right").cast("long").alias("both_right"),
                    F.col("both_wrong").cast("long").alias("both_wrong"), F.col("only_a").cast("long").alias("only_a"),
                    F.col("only_b").cast("long").alias("only_b"),
                    F.when(ad + bc != 0, (ad - bc) / (ad + bc)).alias("q_stat"), "corr",
                    (F.lit(1.0) - F.col("corr")).alias("diversity"))


def accuracy(pred: Column, label: Column) -> Column:
    return F.avg((pred == label).cast("double"))
