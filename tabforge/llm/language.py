"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained with follow-the-regularised-leader (per-coordinate
steps, elastic-net penalties) and calibrated by one temperature.

Features are n-grams of 1 to ``n_max`` code points of the lower-cased text
(runs of anything but letters count as one blank), hashed to ``1 << bits``
slots; weight log(1 + tf) * idf, scaled to unit length. Document frequencies
are sums over all training rows. The classifier learns from a sample of them,
about ``per_class`` rows of each language drawn by hash; every fifth row of the
sample is kept out of training and fits the temperature. Both are documented
bounds; prediction covers every whole text.

Training rows leave their tasks as sparse vectors (at most ``1 << bits``
entries whatever the text's length); so the driver holds languages x per_class
such rows and one weight matrix.

Defined results: a null text or one without a letter is ``und`` with score 0;
repeated rows are predicted alike; rows with a null language or text don't
train; without any training row everything is ``und``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.session import cut_lineage

_OTHER = re.compile(r"[\W\d_]+")
_PIECE = 1 << 18  # code points hashed at a time


def ngram_counts(text: str, bits: int, n_max: int) -> np.ndarray:
    """Counts of hashed n-grams of the whole text."""
    total = np.zeros(1 << bits, dtype=np.int64)
    points = np.frombuffer((" " + _OTHER.sub(" ", text.lower()).strip() + " ").encode("utf-32-le"), dtype=np.uint32)
    for at in range(0, len(points), _PIECE):
        part = points[at:at + _PIECE + n_max - 1]  # grams that begin in the piece
        code = np.zeros(len(part), dtype=np.uint64)
        for n in range(1, n_max + 1):
            code = code[:len(part) - n + 1] * np.uint64(0x100000001B3) + part[n - 1:].astype(np.uint64) + np.uint64(1)
            own = code[:min(_PIECE, len(code))]
            slot = (own * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
            total += np.bincount(slot.astype(np.int64), minlength=1 << bits)
    return total


def _vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(counts)
    x = np.log1p(counts[at]) * idf[at]
    norm = float(np.sqrt(x @ x))
    return at, (x / norm if norm else x)


class LanguageModel:
    """Weights (slots x languages), bias, idf and temperature."""

    def __init__(self, labels: list[str], idf: np.ndarray, bits: int, n_max: int):
        self.labels, self.idf, self.bits, self.n_max = labels, idf, bits, n_max
        self.weights = np.zeros((1 << bits, len(labels)))
        self.bias = np.zeros(len(labels))
        self.temperature = 1.0

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int, alpha: float, l1: float, l2: float, seed: int) -> None:
        """FTRL-proximal, one row a step; rows: (slots, values, label index)."""
        k, beta = len(self.labels), 1.0
        z, n = np.zeros_like(self.weights), np.zeros_like(self.weights)
        zb, nb = np.zeros(k), np.zeros(k)
        order = np.random.default_rng(seed)
        for _ in range(epochs):
            for i in order.permutation(len(rows)):
                at, x, y = rows[i]
                w = _proximal(z[at], n[at], alpha, beta, l1, l2)
                b = _proximal(zb, nb, alpha, beta, 0.0, l2)
                p = _softmax((x @ w + b)[None])[0]
                p[y] -= 1.0
                g = x[:, None] * p[None]
                step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
                z[at] += g - step * w
                n[at] += g * g
                step = (np.sqrt(nb + p * p) - np.sqrt(nb)) / alpha
                zb += p - step * b
                nb += p * p
        self.weights = _proximal(z, n, alpha, beta, l1, l2)
        self.bias = _proximal(zb, nb, alpha, beta, 0.0, l2)

    def logits(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[at] + self.bias

    def calibrate(self, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
        """The temperature with the least log loss on rows that did not train (golden-section search)."""
        if not rows or len(self.labels) < 2:
            return
        logits, y = np.stack([self.logits(at, x) for at, x, _ in rows]), np.array([r[2] for r in rows])

        def loss(log_t: float) -> float:
            p = _softmax(logits / np.exp(log_t))
            return -float(np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean())

        low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
        for _ in range(40):
            a, b = high - ratio * (high - low), low + ratio * (high - low)
            low, high = (low, b) if loss(a) < loss(b) else (a, high)
        self.temperature = float(np.exp((low + high) / 2))

    def predict(self, text: str) -> tuple[str, float]:
        p = _softmax((self.logits(*_vector(ngram_counts(text, self.bits, self.n_max), self.idf)) / self.temperature)[None])[0]
        best = int(p.argmax())
        return self.labels[best], float(min(1.0, p[best]))


def _proximal(z, n, alpha, beta, l1, l2):
    return -np.sign(z) * np.maximum(np.abs(z) - l1, 0.0) / ((beta + np.sqrt(n)) / alpha + l2)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def train(df: DataFrame, text_col: str = "text", label_col: str = "lang", key_col: str = "doc_id", bits: int = 13,
          n_max: int = 3, per_class: int = 600, epochs: int = 4, alpha: float = 0.5, l1: float = 0.002, l2: float = 0.01,
          seed: int = 7) -> LanguageModel:
    """Fits on the rows of ``df`` that have a text with a letter and a label."""
    rows = (df.select(F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label"),
                      F.xxhash64(F.lit(seed), F.col(key_col), F.col(text_col)).alias("draw"))
            .where(F.col("label").isNotNull() & has_letter(F.col("text"))))
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # one row per language
    labels = sorted(sizes)
    if not labels:
        return LanguageModel([], np.zeros(1 << bits), bits, n_max)
    # each language keeps the rows whose hash lies below its share
    share = F.coalesce(*[F.when(F.col("label") == lab, F.lit(min(1.0, per_class / sizes[lab]))) for lab in labels])
    drawn = (F.shiftrightunsigned("draw", 11) / F.lit(float(1 << 53))) < share
    slots = 1 << bits
    names = ["label", "draw", "slots", "counts", "row_slots", "row_counts"]

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(slots, dtype=np.int64)  # documents of this task that hold each slot
        for batch in batches:
            got: list[tuple] = []
            for text, label, draw, take in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = ngram_counts(text, bits, n_max)
                seen += counts > 0
                if take:
                    at = np.flatnonzero(counts)
                    got.append((label, draw, at.astype(np.int32).tobytes(), counts[at].tobytes()))
            if got:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.int64()),
                     pa.nulls(len(got), pa.list_(pa.int32())), pa.nulls(len(got), pa.list_(pa.int64())),
                     pa.array([g[2] for g in got], pa.binary()), pa.array([g[3] for g in got], pa.binary())], names=names)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([0], pa.int64()),
                                          pa.array([at.astype(np.int32)], pa.list_(pa.int32())),
                                          pa.array([seen[at]], pa.list_(pa.int64())), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary())],
                                         names=names)

    made = cut_lineage(rows.select("text", "label", "draw", drawn.alias("take"))
                       .mapInArrow(features, "label string, draw long, slots array<int>, counts array<long>, row_slots binary, row_counts binary"))
    df_rows = (made.where("label is null").select(F.explode(F.arrays_zip("slots", "counts")).alias("c"))
               .groupBy("c.slots").agg(F.sum("c.counts").alias("n")).collect())  # one row per slot
    seen = np.zeros(slots)
    for r in df_rows:
        seen[r["slots"]] = r["n"]
    total = sum(sizes.values())
    idf = np.log((1.0 + total) / (1.0 + seen)) + 1.0
    model = LanguageModel(labels, idf, bits, n_max)
    index = {lab: i for i, lab in enumerate(labels)}
    sample = []
    for r in made.where("label is not null").select("label", "draw", "row_slots", "row_counts").toLocalIterator():
        counts = np.zeros(slots, dtype=np.int64)
        counts[np.frombuffer(r["row_slots"], dtype=np.int32)] = np.frombuffer(r["row_counts"], dtype=np.int64)
        at, x = _vector(counts, idf)
        sample.append((r["draw"], r["label"], at.astype(np.int32), x))
    sample.sort(key=lambda r: (r[0], r[1]))  # the same order however Spark returned them
    data = [(at, x, index[lab]) for _, lab, at, x in sample]
    model.fit([d for i, d in enumerate(data) if i % 5], epochs, alpha, l1, l2, seed)
    model.calibrate(data[::5])
    return model


def predict(df: DataFrame, model: LanguageModel, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """Adds the predicted language and its calibrated probability."""
    handle = df.sparkSession.sparkContext.broadcast(model)  # 8 bytes x slots x languages
    work = "_language"

    @F.pandas_udf(f"{pred_col} string, {score_col} double")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([handle.value.predict(t) if t is not None else (None, None) for t in texts],
                               columns=[pred_col, score_col])

    text = F.col(text_col)
    if not model.labels:
        return df.withColumns({pred_col: F.lit("und"), score_col: F.lit(0.0)})
    return (df.withColumn(work, judged(F.when(has_letter(text), text)))
            .withColumns({pred_col: F.coalesce(F.col(f"{work}.{pred_col}"), F.lit("und")),
                          score_col: F.coalesce(F.col(f"{work}.{score_col}"), F.lit(0.0))}).drop(work))
