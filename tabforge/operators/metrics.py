"""Binary-classification metrics from a long prediction table.

Every curve metric starts from ``score_counts`` — positives and negatives per
(keys, distinct score) — so the heavy work is one partial aggregation; running
totals over scores use the bucketed running sum (no single-task global sort).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.operators.common import as_list, checked_broadcast
from tabforge.operators.ranking import bucketed_running_sum


def score_counts(df: DataFrame, score: str, label: str, keys=None) -> DataFrame:
    keys = as_list(keys)
    y = F.col(label).cast("long")
    return df.groupBy(*keys, score).agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg"))


def _totals(counts: DataFrame, keys: list[str]) -> DataFrame:
    return counts.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))


def roc_auc(df: DataFrame, score: str, label: str, keys=None, name: str = "auc") -> DataFrame:
    """Area under ROC with tied scores counted half (Mann-Whitney)."""
    keys = as_list(keys)
    c = score_counts(df, score, label, keys)
    r = bucketed_running_sum(c, keys, score, ["neg"], descending=False)
    part = r.groupBy(*keys).agg(
        F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") * F.lit(0.5))).alias("_u"),
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return part.select(*keys, (F.col("_u") / (F.col("_p") * F.col("_n"))).alias(name))


def curve_points(df: DataFrame, score: str, label: str, keys=None) -> DataFrame:
    """Per distinct score (descending cut ``score >= s``): cumulative tp/fp
    and class totals; the common input of N3, N4, N11, N12."""
    keys = as_list(keys)
    c = score_counts(df, score, label, keys)
    r = bucketed_running_sum(c, keys, score, ["pos", "neg"], descending=True)
    tot = _totals(c, keys)
    return r.join(tot, keys) if keys else r.crossJoin(tot)


def roc_points(df: DataFrame, score: str, label: str, keys=None, points: DataFrame | None = None) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, plus (inf, 0, 0).
    ``points`` reuses a ``curve_points`` result (ROC and PR share one pass)."""
    keys = as_list(keys)
    p = points if points is not None else curve_points(df, score, label, keys)
    pts = p.select(*keys, F.col(score).cast("double").alias("threshold"),
                   (F.col("cum_neg") / F.col("N")).alias("fpr"), (F.col("cum_pos") / F.col("P")).alias("tpr"))
    start = p.select(*keys).distinct().select(*keys, F.lit(float("inf")).alias("threshold"),
                                              F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


def pr_points(df: DataFrame, score: str, label: str, keys=None, points: DataFrame | None = None) -> DataFrame:
    """(threshold, precision, recall) for every distinct score."""
    keys = as_list(keys)
    p = points if points is not None else curve_points(df, score, label, keys)
    return p.select(*keys, F.col(score).cast("double").alias("threshold"),
                    (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                    (F.col("cum_pos") / F.col("P")).alias("recall"))


def youden_threshold(df: DataFrame, score: str, label: str, keys=None, points: DataFrame | None = None) -> DataFrame:
    """First arg-max of tpr - fpr (ties -> highest threshold)."""
    keys = as_list(keys)
    r = roc_points(df, score, label, keys, points).withColumn("j", F.col("tpr") - F.col("fpr"))
    best = r.groupBy(*keys).agg(F.max(F.struct("j", "threshold", "tpr", "fpr")).alias("b"))
    return best.select(*keys, F.col("b.threshold").alias("threshold"), F.col("b.tpr").alias("tpr"),
                       F.col("b.fpr").alias("fpr"), F.col("b.j").alias("youden"))


def f1_threshold(df: DataFrame, score: str, label: str, keys=None, eps: float = 1e-10,
                 points: DataFrame | None = None) -> DataFrame:
    """Arg-max of 2pr/(p+r+eps) over thresholds (ties -> lowest)."""
    keys = as_list(keys)
    p = pr_points(df, score, label, keys, points)
    p = p.withColumn("f1", F.lit(2.0) * F.col("precision") * F.col("recall")
                     / (F.col("precision") + F.col("recall") + F.lit(eps)))
    best = p.groupBy(*keys).agg(F.max(F.struct(F.col("f1"), (-F.col("threshold")).alias("nt"),
                                               F.col("precision"), F.col("recall"))).alias("b"))
    return best.select(*keys, (-F.col("b.nt")).alias("threshold"), F.col("b.precision").alias("precision"),
                       F.col("b.recall").alias("recall"), F.col("b.f1").alias("f1"))


def confusion_counts(df: DataFrame, label: str, pred: str, keys=None) -> DataFrame:
    """N6 (long form): (keys, label, pred, n)."""
    keys = as_list(keys)
    return df.groupBy(*keys, label, pred).agg(F.count(F.lit(1)).alias("n"))


def _rates(tp: Column, fp: Column, tn: Column, fn: Column) -> dict[str, Column]:
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, F.lit(2.0) * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    return {"accuracy": (tp + tn) / (tp + tn + fp + fn), "precision": prec, "recall": rec, "f1": f1,
            "recall_neg": F.when(tn + fp > 0, tn / (tn + fp)).otherwise(F.lit(0.0)), "recall_pos": rec}


def binary_metrics(df: DataFrame, label: str, pred: str, keys=None) -> DataFrame:
    """Accuracy, precision, recall, F1, per-class recall."""
    keys = as_list(keys)
    y, p = F.col(label), F.col(pred)
    c = df.groupBy(*keys).agg(
        F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0)).cast("double").alias("tp"),
        F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0)).cast("double").alias("fp"),
        F.sum(F.when((y == 0) & (p == 0), 1).otherwise(0)).cast("double").alias("tn"),
        F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0)).cast("double").alias("fn"))
    r = _rates(F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn"))
    return c.select(*keys, *[v.alias(k) for k, v in r.items()])


def threshold_sweep(df: DataFrame, score: str, label: str, thresholds: DataFrame, keys=None,
                    inclusive: bool = True) -> DataFrame:
    """All metrics for every threshold row (``name``, ``threshold`` and
    optionally ``keys``) from the per-score counts in one aggregation; the
    threshold table is small (bounded by its rows) and broadcast."""
    keys = as_list(keys)
    c = score_counts(df, score, label, keys)
    tkeys = [k for k in keys if k in thresholds.columns]
    th = checked_broadcast(thresholds)
    j = c.join(th, tkeys) if tkeys else c.crossJoin(th)
    hit = (F.col(score) >= F.col("threshold")) if inclusive else (F.col(score) > F.col("threshold"))
    g = j.groupBy(*keys, "name", "threshold").agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).cast("double").alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).cast("double").alias("fp"),
        F.sum(F.when(~hit, F.col("neg")).otherwise(0)).cast("double").alias("tn"),
        F.sum(F.when(~hit, F.col("pos")).otherwise(0)).cast("double").alias("fn"))
    r = _rates(F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn"))
    return g.select(*keys, "name", "threshold", *[v.alias(k) for k, v in r.items()])


def classification_report(df: DataFrame, label: str, pred: str, keys=None) -> DataFrame:
    """Per class precision/recall/F1/support, macro and weighted
    averages and accuracy, long form ``(keys, row, precision, recall, f1, support)``."""
    keys = as_list(keys)
    m = binary_metrics(df, label, pred, keys)
    sup = df.groupBy(*keys).agg(F.sum(F.col(label)).cast("double").alias("s1"),
                                F.count(F.lit(1)).cast("double").alias("n"))
    c = df.groupBy(*keys).agg(
        F.sum(F.when((F.col(label) == 0) & (F.col(pred) == 0), 1).otherwise(0)).cast("double").alias("tn"),
        F.sum(F.when((F.col(label) == 1) & (F.col(pred) == 0), 1).otherwise(0)).cast("double").alias("fn"))
    x = m.join(sup, keys).join(c, keys) if keys else m.crossJoin(sup).crossJoin(c)
    p0 = F.when(F.col("tn") + F.col("fn") > 0, F.col("tn") / (F.col("tn") + F.col("fn"))).otherwise(F.lit(0.0))
    r0 = F.col("recall_neg")
    f0 = F.when(p0 + r0 > 0, F.lit(2.0) * p0 * r0 / (p0 + r0)).otherwise(F.lit(0.0))
    s0 = F.col("n") - F.col("s1")
    x = x.select(*keys, F.col("precision").alias("p1"), F.col("recall").alias("r1"), F.col("f1").alias("f1_"),
                 p0.alias("p0"), r0.alias("r0"), f0.alias("f0"), F.col("s1"), s0.alias("s0"), "n", "accuracy")
    rows = F.array(
        F.struct(F.lit("0").alias("row"), F.col("p0").alias("precision"), F.col("r0").alias("recall"),
                 F.col("f0").alias("f1"), F.col("s0").alias("support")),
        F.struct(F.lit("1").alias("row"), F.col("p1").alias("precision"), F.col("r1").alias("recall"),
                 F.col("f1_").alias("f1"), F.col("s1").alias("support")),
        F.struct(F.lit("macro avg").alias("row"), ((F.col("p0") + F.col("p1")) / 2).alias("precision"),
                 ((F.col("r0") + F.col("r1")) / 2).alias("recall"), ((F.col("f0") + F.col("f1_")) / 2).alias("f1"),
                 F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("row"),
                 ((F.col("p0") * F.col("s0") + F.col("p1") * F.col("s1")) / F.col("n")).alias("precision"),
                 ((F.col("r0") * F.col("s0") + F.col("r1") * F.col("s1")) / F.col("n")).alias("recall"),
                 ((F.col("f0") * F.col("s0") + F.col("f1_") * F.col("s1")) / F.col("n")).alias("f1"),
                 F.col("n").alias("support")),
        F.struct(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), F.col("accuracy").alias("f1"), F.col("n").alias("support")))
    return x.select(*keys, F.inline(rows))


def brier(p: Column, y: Column) -> Column:
    """N9 (aggregate)"""
    return F.avg(F.pow(p - y.cast("double"), 2))


def log_loss(p: Column, y: Column, eps: float = 1e-15) -> Column:
    """N10 (aggregate), probabilities clipped to [eps, 1 - eps]."""
    q = F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps))
    yd = y.cast("double")
    return F.avg(-(yd * F.log(q) + (F.lit(1.0) - yd) * F.log(F.lit(1.0) - q)))


def bin_calibrate(df: DataFrame, score: str, label: str, keys=None, n_bins: int = 10,
                  out: str = "calibrated") -> DataFrame:
    """Histogram-binning calibration: each score replaced by the label rate of
    its equal-width bin (learnt on ``df``; a small (keys, bin) table)."""
    keys = as_list(keys)
    b = F.least(F.floor(F.col(score) * n_bins), F.lit(n_bins - 1)).cast("int")
    x = df.withColumn("_bin", b)
    rates = x.groupBy(*keys, "_bin").agg(F.avg(F.col(label).cast("double")).alias(out))
    return x.join(checked_broadcast(rates), keys + ["_bin"]).drop("_bin")
