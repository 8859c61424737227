"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the presence of hashed character n-grams learns from
confirmed toxic texts and unlabelled ones with the risk
``prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)])`` (logistic
loss); when the second part turns negative, steps go back along it. Training is
numpy on the driver over bounded samples drawn by hash (``positives`` and
``unlabelled`` rows, sparse slots of at most ``1 << bits``); an L1 step keeps
few weights. The class prior is the share of toxic among labelled training
rows unless it is given. Scoring covers every whole text in one pass.

Defined results: a null or empty text has no n-gram and gets the score of the
bias; repeated rows score alike; without a positive or an unlabelled training
row every score is the prior; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.session import cut_lineage

_OTHER = re.compile(r"[\W\d_]+")
_PIECE = 1 << 18


def slots_of(text: str, bits: int, sizes: tuple[int, ...], keep: np.ndarray | None = None) -> np.ndarray:
    """Distinct slots of the text's n-grams, in order; with ``keep``, only those marked there."""
    points = np.frombuffer((" " + _OTHER.sub(" ", text.lower()).strip() + " ").encode("utf-32-le"), dtype=np.uint32)
    found = []
    for at in range(0, len(points), _PIECE):
        part = points[at:at + _PIECE + max(sizes) - 1].astype(np.uint64) + np.uint64(1)
        code = np.zeros(len(part), dtype=np.uint64)
        for n in range(1, max(sizes) + 1):
            code = code[:max(0, len(part) - n + 1)] * np.uint64(0x100000001B3) + part[n - 1:]
            if n in sizes:
                slot = ((code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)
                found.append(np.unique(slot if keep is None else slot[keep[slot]]))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)


class ToxicityModel:
    def __init__(self, prior: float, bits: int, sizes: tuple[int, ...]):
        self.bits, self.sizes, self.prior = bits, sizes, prior
        self.weights = np.zeros(1 << bits)
        self.bias = float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))

    def fit(self, positive: list[np.ndarray], unlabelled: list[np.ndarray], epochs: int, rate: float, l1: float,
            min_df: int, batches: int, seed: int, relax: float = 0.02) -> None:
        """First with the L1 step, which picks slots; then with those alone and no penalty, so that margins are not shrunk."""
        df = np.bincount(np.concatenate(positive + unlabelled), minlength=1 << self.bits)
        use = df >= min_df  # a slot in a few texts says nothing about others
        for penalty in (l1, l1 * relax):
            positive, unlabelled = [p[use[p]] for p in positive], [u[use[u]] for u in unlabelled]
            self._descend(positive, unlabelled, epochs, rate, penalty, batches, seed)
            use = self.weights != 0
        self._stretch(positive, unlabelled)

    def _stretch(self, positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> None:
        """Undoes the shrinking of margins: the scale and shift with the least risk, on a grid."""
        theta = np.append(self.weights, self.bias)
        gp, gu, pi = _margins(positive, theta), _margins(unlabelled, theta), self.prior

        def risk(a: float, b: float) -> float:
            p, u = a * gp + b, a * gu + b
            return pi * np.logaddexp(0, -p).mean() + max(0.0, np.logaddexp(0, u).mean() - pi * np.logaddexp(0, p).mean())

        a, b = min(((a, b) for a in np.linspace(0.5, 6, 23) for b in np.linspace(-4, 8, 49)), key=lambda x: risk(*x))
        self.weights, self.bias = self.weights * a, self.bias * a + b

    def _descend(self, positive, unlabelled, epochs, rate, l1, batches, seed) -> None:
        """Mini-batch Adam with a proximal L1 step; each batch has a share of both samples."""
        order, pi = np.random.default_rng(seed), self.prior
        size = (1 << self.bits) + 1
        theta = np.append(self.weights, self.bias)
        m, v, step = np.zeros(size), np.zeros(size), 0
        for _ in range(epochs):
            ps, us = order.permutation(len(positive)), order.permutation(len(unlabelled))
            for b in range(batches):
                p = [positive[i] for i in ps[b::batches]]
                u = [unlabelled[i] for i in us[b::batches]]
                if not p or not u:
                    continue
                gp, gu = _margins(p, theta), _margins(u, theta)
                # logistic loss: dl(g)/dg = -s(-g), dl(-g)/dg = s(g)
                sp, su = _sigmoid(gp), _sigmoid(gu)
                rest = np.logaddexp(0, gu).mean() - pi * np.logaddexp(0, gp).mean()
                dp, du = -pi * sp / len(p), su / len(u)
                if rest >= 0:
                    dp = dp - pi * (1 - sp) / len(p)
                else:
                    dp, du = -dp, -du
                grad = _gather(p, dp, size) + _gather(u, du, size)
                step += 1
                m = 0.9 * m + 0.1 * grad
                v = 0.999 * v + 0.001 * grad * grad
                move = rate / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-4)
                theta -= move * (m / (1 - 0.9 ** step))
                theta[:-1] = np.maximum(theta[:-1] - move[:-1] * l1, 0.0)  # clean n-grams do not outweigh toxic ones
        self.weights, self.bias = theta[:-1], float(theta[-1])

    def score(self, text: str | None) -> float:
        if not text:
            return float(_sigmoid(np.array([self.bias]))[0])
        return float(_sigmoid(np.array([self.bias + self.weights[slots_of(text, self.bits, self.sizes, self.weights != 0)].sum()]))[0])


def _margins(rows: list[np.ndarray], theta: np.ndarray) -> np.ndarray:
    return np.array([theta[r].sum() for r in rows]) + theta[-1]


def _gather(rows: list[np.ndarray], d: np.ndarray, size: int) -> np.ndarray:
    out = np.bincount(np.concatenate(rows), weights=np.repeat(d, [len(r) for r in rows]), minlength=size)
    out[-1] = d.sum()
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic",
          prior: float | None = None, positives: int = 2000, unlabelled: int = 4000, bits: int = 17,
          sizes: tuple[int, ...] = (4, 5), epochs: int = 40, rate: float = 0.02, l1: float = 4e-3, min_df: int = 5,
          batches: int = 20, seed: int = 23) -> ToxicityModel:
    """``docs`` and ``labels`` are the training rows only; an id is toxic if one of its labels is 1."""
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_y"))
    counts = {r["_y"]: r["count"] for r in marks.groupBy("_y").count().collect()}
    known = counts.get(0, 0) + counts.get(1, 0)
    pi = prior if prior is not None else counts.get(1, 0) / known if known else 0.5
    model = ToxicityModel(min(max(pi, 0.001), 0.999), bits, sizes)
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    total = rows.count()
    if not counts.get(1) or not total:
        return model
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("id")), 11) / F.lit(float(1 << 53))
    # both samples are drawn by hash before any text moves; twice the share meets the bound after sorting
    chosen = marks.where("_y = 1").select(F.col("_id").alias("id"), F.lit(True).alias("p"))
    chosen = chosen.where(draw < F.lit(min(1.0, 1.2 * positives / counts[1])))
    pos = rows.join(chosen, "id").select("text", "p", draw.alias("draw"))
    unl = rows.where(F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), F.col("id")), 11) / F.lit(float(1 << 53))
                     < F.lit(min(1.0, 1.2 * unlabelled / total))).select("text", F.lit(False).alias("p"), draw.alias("draw"))

    def features(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_:
            got = [slots_of(t, bits, sizes).astype(np.int32).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.binary()), batch.column(1), batch.column(2)],
                                             names=["slots", "p", "draw"])

    made = cut_lineage(pos.unionByName(unl).mapInArrow(features, "slots binary, p boolean, draw double"))
    held: dict[bool, list[tuple]] = {True: [], False: []}
    for r in made.toLocalIterator():
        held[r["p"]].append((r["draw"], len(r["slots"]), np.frombuffer(r["slots"], dtype=np.int32)))
    for got in held.values():
        got.sort(key=lambda x: (x[0], x[1], x[2].tobytes()))
    p, u = [x[2] for x in held[True][:positives]], [x[2] for x in held[False][:unlabelled]]
    if p and u:
        model.fit(p, u, epochs, rate, l1, min_df, batches, seed)
    return model


def score(df: DataFrame, model: ToxicityModel, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """Adds the probability that the whole text is toxic."""
    handle = df.sparkSession.sparkContext.broadcast(model)  # 8 bytes x slots

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(handle.value.score, na_action=None).astype("float64")

    return df.withColumn(out_col, scored(F.coalesce(F.col(text_col), F.lit(""))))
