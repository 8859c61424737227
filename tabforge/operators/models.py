"""Model training and validation.

All fits go through joint training (``tabforge.training``): the frame is packed
once, and the folds and configurations of a call are fitted side by side from
shared passes over the blocks, so that the number of jobs depends on the steps of the
longest fit, not on models or folds. Predictions come back as the long table
``(id, model, seed, fold, label, proba, pred)`` that the metric and ensemble
operators consume. Features and labels must be known: a null or NaN is an error.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tabforge.operators.encode import standard_scaler
from tabforge.operators.folds import stratified_folds
from tabforge.session import cut_lineage


@dataclass
class ModelSpec:
    """A named model configuration.

    kinds: ``logreg`` (params C, l1_ratio, max_iter), ``forest`` (n_trees,
    max_depth, min_samples_split, min_samples_leaf, max_features, bootstrap),
    ``gbt`` (n_rounds, max_depth, learning_rate, subsample, min_leaf,
    min_gain, max_features), ``rff`` (C, n_components, gamma: random Fourier
    features of the RBF kernel + logistic output).
    """
    name: str
    kind: str
    params: dict = field(default_factory=dict)


def _with_counts(spec: ModelSpec, n_features: int) -> ModelSpec:
    """Forests with the numbers behind their rules: features tried at a node rounded up, and both sides of a split holding
    half of ``min_samples_split`` at least."""
    if spec.kind != "forest":
        return spec
    p, rule = spec.params, spec.params.get("max_features", "sqrt")
    tried = {"sqrt": math.ceil(math.sqrt(n_features)), "log2": max(1, math.ceil(math.log2(max(n_features, 1))))}.get(rule, rule)
    leaf = max(int(p.get("min_samples_leaf", 1)), math.ceil(int(p.get("min_samples_split", 2)) / 2))
    return ModelSpec(spec.name, spec.kind, p | {"max_features": tried, "min_samples_leaf": leaf})


def rff_weights(n_features: int, n_components: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and phases of random Fourier features."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, n_features))
    return w, rng.uniform(0.0, 2.0 * math.pi, size=n_components)


def rff_columns(features: Sequence[str], n_components: int, gamma: float, seed: int,
                prefix: str = "rff_") -> dict[str, F.Column]:
    """Random Fourier features z_d = sqrt(2/D) cos(w_d . x + b_d) with
    w ~ N(0, 2 gamma I): an explicit map whose inner products approximate the
    RBF kernel. Plain column expressions (JVM, codegen), no UDF."""
    w, b = rff_weights(len(features), n_components, gamma, seed)
    scale = math.sqrt(2.0 / n_components)
    out = {}
    for d in range(n_components):
        dot = F.lit(float(b[d]))
        for j, c in enumerate(features):
            dot = dot + F.lit(float(w[d, j])) * F.col(c)
        out[f"{prefix}{d}"] = F.lit(scale) * F.cos(dot)
    return out


@dataclass
class FittedModel:
    """A model of joint training; ``columns`` are what it reads (after scaler and Fourier features), ``edges`` their bins."""

    spec: ModelSpec
    model: object
    features: list[str]
    columns: list[str]
    edges: list[np.ndarray]
    weights: np.ndarray  # importance of each column
    scaler: object = None
    rff: dict | None = None

    def _prep(self, df: DataFrame) -> DataFrame:
        x = df
        if self.scaler is not None:
            x = self.scaler.transform(x)
        if self.rff is not None:
            x = x.withColumns(self.rff)
        return x

    def predict(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        """Adds ``proba`` (positive class) and ``pred`` (proba >= threshold)."""
        from tabforge.training.fits import LinearModel

        x = self._prep(df)
        if isinstance(self.model, LinearModel):
            z = F.lit(float(self.model.weights[-1]))
            for c, w in zip(self.columns, self.model.weights[:-1], strict=True):
                z = z + F.lit(float(w)) * F.nullif(F.col(c).cast("double"), F.lit(float("nan")))
            proba = F.coalesce(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), F.raise_error(F.lit("features must not be null or NaN")).cast("double"))
        else:
            shared = df.sparkSession.sparkContext.broadcast((self.model, self.edges))  # bounded by the model's size

            kept = x.drop("proba")
            n, at = len(kept.columns), len(self.columns)

            def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                model, edges = shared.value
                for b in batches:
                    raw = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns[n:n + at]])
                    if np.isnan(raw).any():
                        raise ValueError("features must not be null or NaN")
                    yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(model.proba_of(raw, edges), pa.float64())],
                                                     names=[*b.schema.names[:n], "proba"])

            read = kept.select("*", *[x[c].cast("double").alias(f"_read{j}") for j, c in enumerate(self.columns)])
            x = read.mapInArrow(scored, StructType([*kept.schema.fields, StructField("proba", DoubleType())]))
            proba = F.col("proba")
        return x.withColumn("proba", proba).withColumn("pred", (F.col("proba") >= threshold).cast("int"))

    def importances(self, spark: SparkSession) -> DataFrame:
        """Feature importance table sorted descending: gains of the trees, or sizes of the coefficients."""
        rows = sorted(zip(self.features, self.weights.tolist()), key=lambda t: (-t[1], t[0]))
        return spark.createDataFrame([(f, float(v), i + 1) for i, (f, v) in enumerate(rows)],
                                     "feature string, importance double, rank int")


def _with_id(df: DataFrame, id_col: str) -> tuple[DataFrame, str]:
    """Rows are drawn by ``id_col``; without that column, by all values of the row."""
    if id_col in df.columns:
        return df, id_col
    return df.withColumn("_row", F.xxhash64(*df.columns)), "_row"


def fit(spec: ModelSpec, train: DataFrame, features: Sequence[str], label: str = "label", seed: int = 42,
        id_col: str = "id") -> FittedModel:
    """One model on all rows."""
    from tabforge.training.fits import Fit, LinearModel, fit_all, pack_for

    features = list(features)
    scaler, rff, cols, own = None, None, features, _with_counts(spec, len(features))
    train, id_col = _with_id(train, id_col)
    if spec.kind == "rff":
        scaler = standard_scaler(train, features)
        d = int(spec.params.get("n_components", 50))
        gamma = float(spec.params.get("gamma", 1.0 / max(len(features), 1)))  # 'scale' on standardised input
        rff = rff_columns(features, d, gamma, seed)
        cols = list(rff)
        train = scaler.transform(train).withColumns(rff)
        own = ModelSpec(spec.name, "logreg", spec.params)
    packed = pack_for(train, [own], cols, [], label, id_col, strict=True)
    fitted = fit_all(packed, [Fit(own, tuple(range(len(cols))), (), seed)])
    packed.release()
    model = fitted.models[0]
    weights = np.abs(model.weights[:-1]) if isinstance(model, LinearModel) else fitted.importances(0, len(cols))
    return FittedModel(spec, model, features, cols, packed.edges, weights, scaler, rff)


def oof_predictions(df: DataFrame, spec: ModelSpec, features: Sequence[str], label: str = "label",
                    id_col: str = "id", fold_col: str = "fold", seed: int = 42) -> DataFrame:
    """M7: out-of-fold predictions; the fits of all folds (a small distinct set) run together, and the
    predictions are written once, so that no reader of them scores the rows again."""
    from tabforge.training.fits import oof_table

    types = dict(df.select(F.col(fold_col).alias("fold"), F.col(label).alias("label")).dtypes)
    out = oof_table(df, [_with_counts(spec, len(features))], features, label, id_col, fold_col, seed, strict=True)
    return out.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def fold_scores(oof: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """M6: accuracy per (keys, fold)."""
    return oof.groupBy(*keys, "fold").agg(F.avg((F.col("pred") == F.col("label")).cast("double")).alias("score"))


def cv_summary(oof: DataFrame, train_scores: DataFrame | None = None, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Per model mean and population std of fold accuracy, OOF
    accuracy, and (given train scores) the train-CV gap."""
    keys = list(keys)
    fs = fold_scores(oof, keys).groupBy(*keys).agg(F.avg("score").alias("cv_score"), F.stddev_pop("score").alias("cv_std"))
    o = oof.groupBy(*keys).agg(F.avg((F.col("pred") == F.col("label")).cast("double")).alias("oof_score"))
    out = fs.join(o, keys)
    if train_scores is not None:
        out = out.join(train_scores, keys).withColumn("gap", F.col("train_score") - F.col("cv_score"))
    return out


def train_score(spec: ModelSpec, df: DataFrame, features: Sequence[str], label: str = "label",
                seed: int = 42, id_col: str = "id") -> DataFrame:
    """Accuracy of a model fitted on all rows, scored on the same rows."""
    from tabforge.training.fits import cross_fits, fit_all, fit_scores, pack_for

    df, id_col = _with_id(df, id_col)
    packed = pack_for(df, [spec], features, [], label, id_col, strict=True)
    fits = cross_fits(packed, [_with_counts(spec, len(features))], features, [], seed=seed)
    scores = fit_scores(packed, fit_all(packed, fits))  # one row
    packed.release()
    return scores.select("model", (F.col("hits") / F.col("n")).alias("train_score"))


def evaluate(specs: Sequence[ModelSpec], df: DataFrame, features: Sequence[str], label: str = "label",
             id_col: str = "id", fold_col: str = "fold", seed: int = 42, with_train: bool = True) -> DataFrame:
    """M11 building block: CV table for a list of configurations, all of them and all folds fitted together. A
    configuration gives one row, which is taken at once, so that the plan never holds the models of a long list."""
    from tabforge.training.fits import cross_fits, fit_all, fit_scores, folds_of, pack_for, scores_summary

    packed = pack_for(df, specs, features, [fold_col], label, id_col, strict=True)
    folds, fits, extra = folds_of(df, fold_col), [], []
    for i, s in enumerate(specs):
        own = cross_fits(packed, [_with_counts(s, len(features))], features, folds, fold_col, seed, with_train)
        fits += own
        extra += [{"_at": i}] * len(own)
    scores = fit_scores(packed, fit_all(packed, fits), extra)
    packed.release()
    out = scores_summary(scores, ["model", "_at"], with_train).orderBy(F.col("_at").cast("int")).drop("_at")
    return df.sparkSession.createDataFrame(out.collect(), out.schema)  # one row a configuration


def md5_uniform(*parts) -> float:
    """Deterministic U(0,1) draw from a seed path (reproducible search)."""
    h = hashlib.md5(":".join(str(p) for p in parts).encode()).hexdigest()
    return int(h[:13], 16) / float(1 << 52)


def random_configs(name: str, kind: str, space: Mapping[str, tuple], n_trials: int, seed: int = 42) -> list[ModelSpec]:
    """M16 (re-aimed): seeded random search. ``space`` maps a parameter to
    ('int', lo, hi) | ('float', lo, hi) | ('log', lo, hi) | ('cat', [values])."""
    out = []
    for t in range(n_trials):
        p = {}
        for k, spec in sorted(space.items()):
            u = md5_uniform(seed, name, t, k)
            if spec[0] == "int":
                p[k] = int(spec[1] + math.floor(u * (spec[2] - spec[1] + 1)))
            elif spec[0] == "float":
                p[k] = spec[1] + u * (spec[2] - spec[1])
            elif spec[0] == "log":
                p[k] = math.exp(math.log(spec[1]) + u * (math.log(spec[2]) - math.log(spec[1])))
            else:
                vals = spec[1]
                p[k] = vals[min(int(u * len(vals)), len(vals) - 1)]
        out.append(ModelSpec(f"{name}_t{t}", kind, p))
    return out


def isotonic_calibrated_oof(df: DataFrame, spec: ModelSpec, features: Sequence[str], label: str = "label",
                            id_col: str = "id", fold_col: str = "fold", inner_folds: int = 2,
                            seed: int = 42) -> DataFrame:
    """Per outer fold, split the training part in ``inner_folds``; fit
    the base model on k-1 parts, fit isotonic regression on the held-out
    part's scores, average the calibrated probabilities of the inner models
    on the outer validation fold."""
    outer = sorted(r[0] for r in df.select(fold_col).distinct().collect())
    parts = []
    for f in outer:
        tr, va = df.where(F.col(fold_col) != f), df.where(F.col(fold_col) == f)
        tr = tr.withColumn("_inner", F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(inner_folds)))
        cal = None
        for i in range(inner_folds):
            m = fit(spec, tr.where(F.col("_inner") != i), features, label, seed)
            held = m.predict(tr.where(F.col("_inner") == i)).select("proba", F.col(label).cast("double").alias("y"))
            iso = IsotonicRegression(featuresCol="proba", labelCol="y", predictionCol="_cal").fit(held)
            p = iso.transform(m.predict(va).select(id_col, label, "proba")).select(id_col, label, F.col("_cal").alias(f"_c{i}"))
            cal = p if cal is None else cal.join(p.drop(label), id_col)
        avg = sum(F.col(f"_c{i}") for i in range(inner_folds)) / F.lit(float(inner_folds))
        parts.append(cal.select(id_col, F.lit(f"{spec.name}_isotonic").alias("model"), F.lit(f).alias("fold"),
                                F.col(label).alias("label"), avg.alias("proba")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("pred", (F.col("proba") >= 0.5).cast("int"))


def stack_frame(oof: DataFrame, id_col: str = "id", model_col: str = "model", proba: str = "proba",
                models: Sequence[str] | None = None) -> DataFrame:
    """P10: pivot base-model OOF probabilities to one column per model (the
    model list is the small, known set of base models)."""
    models = list(models) if models is not None else sorted(r[0] for r in oof.select(model_col).distinct().collect())
    return oof.groupBy(id_col, "label").pivot(model_col, models).agg(F.first(proba))


def stacked_oof(df: DataFrame, bases: Sequence[ModelSpec], metas: Sequence[tuple[ModelSpec, Sequence[str]]],
                features: Sequence[str], label: str = "label", id_col: str = "id", fold_col: str = "fold",
                inner_folds: int = 5, seed: int = 42) -> DataFrame:
    """Out-of-fold predictions of stacked models, nested. In the training
    part of each outer fold the bases give out-of-fold probabilities over
    ``inner_folds``, on which the metas are fitted; the bases fitted on the
    whole part give the metas' inputs for the held-out fold. A meta comes with
    the original features that it also reads (none without passthrough)."""
    names = [b.name for b in bases]
    keep = sorted({c for _, extra in metas for c in extra})
    parts = []
    for f in sorted(r[0] for r in df.select(fold_col).distinct().collect()):
        tr, va = df.where(F.col(fold_col) != f), df.where(F.col(fold_col) == f)
        inner = cut_lineage(stratified_folds(tr.drop(fold_col), id_col, label, inner_folds, seed, fold_col))
        x, y = inner.select(id_col, label, *keep), va.select(id_col, label, *keep)
        for b in bases:
            oof = oof_predictions(inner, b, features, label, id_col, fold_col, seed)
            x = x.join(oof.select(id_col, F.col("proba").alias(b.name)), id_col)
            held = fit(b, tr, features, label, seed).predict(va)
            y = y.join(held.select(id_col, F.col("proba").alias(b.name)), id_col)
        x, y = cut_lineage(x), cut_lineage(y)
        for spec, extra in metas:
            m = fit(spec, x, names + list(extra), label, seed)
            parts.append(m.predict(y).select(id_col, F.lit(spec.name).alias("model"), F.lit(seed).alias("seed"),
                                             F.lit(f).alias("fold"), F.col(label).alias("label"), "proba", "pred"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def linear_r2(df: DataFrame, target: str, regressors: Sequence[str]) -> float:
    """R^2 of a Spark ``LinearRegression`` (used for VIF cross-checks)."""
    x = VectorAssembler(inputCols=list(regressors), outputCol="_x").transform(df.dropna(subset=[target, *regressors]))
    m = LinearRegression(featuresCol="_x", labelCol=target, regParam=0.0).fit(x)
    return float(m.summary.r2)
