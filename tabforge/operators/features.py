"""Feature-set helpers: per-model selection, long form and vector assembly."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def long_features(df: DataFrame, id_col: str, config: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(id, model, feature, value)`` for each model's own feature list,
    one pass over ``df`` (explode of a literal-shaped array)."""
    items = [F.struct(F.lit(m).alias("model"), F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
             for m, cols in config.items() for c in cols]
    return df.select(id_col, F.explode(F.array(*items)).alias("s")).select(id_col, "s.*")


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """B1 + vectorisation for Spark ML (nulls must be imputed first)."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)
