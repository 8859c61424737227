"""Missing-value operators: fit on one frame, apply to any frame by joins.

Fitted state is a list of small rules DataFrames (keys + ``value``), most
specific first, plus an overall fallback; ``transform`` is a chain of
size-checked broadcast left joins and one ``coalesce``. Nothing is learnt
from the frame being transformed unless the in-frame variant is asked for.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.operators.common import as_list
from tabforge.session import cut_lineage
from tabforge.operators.joins import rule_fill
from tabforge.operators.quantiles import group_mode, group_quantiles, group_quantiles_sets


def group_stat(df: DataFrame, value: str, keys: Sequence[str], stat: str = "median",
               name: str = "value", strategy: str = "auto") -> DataFrame:
    """Per-group statistic of ``value`` (median/mean/mode/count) as a rules table.

    Null keys are dropped (pandas groupby); groups without any value keep a
    null statistic.
    """
    keys = as_list(keys)
    src = df
    for k in keys:
        src = src.where(F.col(k).isNotNull())
    if stat == "median":
        return group_quantiles(src, value, [0.5], keys, [name], strategy=strategy)
    if stat == "mean":
        return src.groupBy(*keys).agg(F.avg(value).alias(name))
    if stat == "mode":
        return group_mode(src, value, keys, name)
    if stat == "count":
        return src.groupBy(*keys).agg(F.count(value).alias(name))
    raise ValueError(f"unknown stat {stat}")


@dataclass
class GroupImputerModel:
    target: str
    levels: list[tuple[list[str], DataFrame]]
    fallback: DataFrame | None
    constant: object = None
    out: str | None = None

    @property
    def rules(self) -> dict[str, DataFrame]:
        d = {"|".join(k) or "overall": r for k, r in self.levels}
        if self.fallback is not None:
            d["overall"] = self.fallback
        return d

    def transform(self, df: DataFrame) -> DataFrame:
        default = self.fallback if self.fallback is not None else self.constant
        return rule_fill(df, self.target, self.levels, default=default, out=self.out)


@dataclass
class GroupImputer:
    """Learn per-group statistics on a train frame, fill any frame.

    ``levels``: key lists, most specific first (e.g. [[cls, title], [cls]]);
    ``overall``: add the whole-frame statistic as the last fallback;
    ``constant``: literal used when no rule applies (C5's last term).
    """
    target: str
    levels: Sequence[Sequence[str]]
    stat: str = "median"
    overall: bool = True
    constant: object = None
    out: str | None = None
    strategy: str = "auto"

    def fit(self, df: DataFrame) -> GroupImputerModel:
        # every level reads the same narrow projection: persist it once
        cols = sorted({c for keys in self.levels for c in keys} | {self.target})
        df = df.select(*cols).persist()
        sets = [list(k) for k in self.levels] + ([[]] if self.overall else [])
        if self.stat == "median":
            # one fused exact-quantile pass for every level (grouping-sets style)
            stats = group_quantiles_sets(df, self.target, [0.5], sets, ["value"], strategy=self.strategy)
        else:
            stats = [group_stat(df, self.target, ks, self.stat, "value", self.strategy) for ks in sets]
        stats = [cut_lineage(r) for r in stats] if self.stat != "median" else stats
        levels = [(list(ks), r.where(F.col("value").isNotNull()))
                  for ks, r in zip(sets[:len(self.levels)], stats)]
        fb = stats[-1] if self.overall else None
        df.unpersist()
        return GroupImputerModel(self.target, levels, fb, self.constant, self.out)


def fill_constant(df: DataFrame, values: dict) -> DataFrame:
    """J1"""
    return df.fillna(values)


def fill_global(df: DataFrame, target: str, stat: str = "median", source: DataFrame | None = None,
                out: str | None = None) -> DataFrame:
    """Fill with the whole-frame median/mean/mode of ``source``."""
    return GroupImputer(target, [], stat=stat, overall=True, out=out).fit(source or df).transform(df)


def fill_in_frame(df: DataFrame, target: str, keys: Sequence[str], stat: str = "median",
                  out: str | None = None) -> DataFrame:
    """Fill with the row's own-frame group statistic (groups without
    values stay null). Kept for parity; prefer fit/transform."""
    return GroupImputer(target, [list(keys)], stat=stat, overall=False, out=out).fit(df).transform(df)


def missing_flags(df: DataFrame, cols: Sequence[str], suffix: str = "_missing") -> DataFrame:
    """0/1 flags before filling."""
    return df.withColumns({f"{c}{suffix}": F.col(c).isNull().cast("int") for c in cols})


def presence_flag(col: str) -> Column:
    """J11"""
    return F.col(col).isNotNull().cast("int")


def rules_summary(model: GroupImputerModel) -> DataFrame:
    """Number of rules per level (+ overall value)."""
    parts = []
    for keys, r in model.levels:
        parts.append(r.agg(F.count(F.lit(1)).alias("n_rules")).select(
            F.lit("|".join(keys)).alias("level"), "n_rules"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


__all__ = ["GroupImputer", "GroupImputerModel", "group_stat", "fill_constant", "fill_global",
           "fill_in_frame", "missing_flags", "presence_flag", "rules_summary"]


@dataclass
class ChainedRuleImputerModel:
    steps: list[GroupImputerModel]

    def transform(self, df: DataFrame) -> DataFrame:
        for m in self.steps:
            df = m.transform(df)
        return df

    def summary(self) -> DataFrame:
        """Number of rules per (target, level) of every step."""
        parts = []
        for m in self.steps:
            for keys, r in m.levels:
                parts.append(r.agg(F.count(F.lit(1)).alias("n_rules")).select(
                    F.lit(m.target).alias("target"), F.lit("|".join(keys)).alias("level"), "n_rules"))
            if m.fallback is not None:
                parts.append(m.fallback.agg(F.count(F.col("value")).alias("n_rules")).select(
                    F.lit(m.target).alias("target"), F.lit("overall").alias("level"), "n_rules"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


@dataclass
class ChainedRuleImputer:
    """Several group imputers learnt on the same train frame and applied
    in order, so a later step keys on an earlier step's filled column (fare
    rules keyed by the filled port, age rules by title)."""
    steps: Sequence[GroupImputer]

    def fit(self, df: DataFrame) -> ChainedRuleImputerModel:
        return ChainedRuleImputerModel([s.fit(df) for s in self.steps])


@dataclass
class ChainedLinearModel:
    means: dict
    steps: list  # (target, inputs, fitted LinearRegressionModel)

    def transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.feature import VectorAssembler
        targets = list(self.means)
        cur = df.withColumns({f"_obs_{c}": F.col(c).isNotNull() for c in targets}).fillna(self.means)
        for c, inputs, lr in self.steps:
            x = VectorAssembler(inputCols=inputs, outputCol="_x").transform(cur)
            x = lr.transform(x)
            cur = x.withColumn(c, F.when(F.col(f"_obs_{c}"), F.col(c)).otherwise(F.col("_pred"))).drop("_x", "_pred")
        return cur.drop(*[f"_obs_{c}" for c in targets])


@dataclass
class ChainedLinearImputer:
    """Iterative (chained) imputation. Start from column means, then for
    ``max_rounds`` rounds regress each target on the other targets and the
    predictors with Spark ``LinearRegression`` (fit on rows where the target
    was observed) and replace only the missing cells. The frame is
    checkpointed to the shared checkpoint folder after every round."""
    targets: Sequence[str]
    predictors: Sequence[str]
    max_rounds: int = 10

    def fit(self, df: DataFrame) -> ChainedLinearModel:
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.regression import LinearRegression

        from tabforge.session import cut_lineage
        targets = list(self.targets)
        row = df.agg(*[F.avg(c).alias(c) for c in targets]).first()
        means = {c: float(row[c]) for c in targets}
        cur = df.withColumns({f"_obs_{c}": F.col(c).isNotNull() for c in targets}).fillna(means)
        steps = []
        for _ in range(self.max_rounds):
            for c in targets:
                inputs = [t for t in targets if t != c] + list(self.predictors)
                x = VectorAssembler(inputCols=inputs, outputCol="_x").transform(cur)
                lr = LinearRegression(featuresCol="_x", labelCol=c, predictionCol="_pred").fit(
                    x.where(F.col(f"_obs_{c}")))
                cur = lr.transform(x).withColumn(c, F.when(F.col(f"_obs_{c}"), F.col(c)).otherwise(F.col("_pred"))) \
                    .drop("_x", "_pred")
                steps.append((c, inputs, lr))
            cur = cut_lineage(cur)
        return ChainedLinearModel(means, steps)
