"""Distributed isotonic regression (P12): pooled blocks per score range, merged by key.

Scores are reduced to (key, score) with weight and label sum, dealt by range of
(key, score) and pooled in each range by the adjacent-violators rule. Pooling
the ranges' blocks again gives the same answer as pooling all points, so a
key's last step sees only blocks. Scores to predict ride along with no
weight and take the value of the block at or before them (the first block, where none is).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.session import cut_lineage


def pooled(weights: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Number of the block of each point after pooling neighbours until block means rise (weights above 0)."""
    w: list[float] = []
    s: list[float] = []
    n: list[int] = []
    for a, b in zip(weights, sums, strict=True):
        w.append(float(a))
        s.append(float(b))
        n.append(1)
        while len(w) > 1 and s[-2] * w[-1] >= s[-1] * w[-2]:
            for stack in (w, s, n):
                top = stack.pop()
                stack[-1] += top
    return np.repeat(np.arange(len(n)), n)


def _key_runs(keys: list) -> Iterator[tuple[int, int]]:
    start = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[start]:
            yield start, i
            start = i


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Points of one range, in order, with the first score of their pooled block (null before the range's first weight)."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    t = pa.Table.from_batches(rows)
    keys, score, w, s = (t.column(c).to_pylist() if c == "key" else t.column(c).to_numpy() for c in ("key", "score", "w", "s"))
    begin = np.full(len(score), np.nan)
    for a, b in _key_runs(keys):
        heavy = a + np.flatnonzero(w[a:b] > 0)
        if len(heavy):
            block = pooled(w[heavy], s[heavy])
            first = score[heavy][np.searchsorted(block, np.arange(block[-1] + 1))]
            at = np.searchsorted(heavy, np.arange(a, b), side="right") - 1
            begin[a:b] = np.where(at >= 0, first[block[np.maximum(at, 0)]], np.nan)
    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(score), pa.array(w), pa.array(s), pa.array(begin, mask=np.isnan(begin))],
                                     names=["key", "score", "w", "s", "begin"])


def _merged(table: pa.Table) -> pa.Table:
    """Values of one key's blocks."""
    t = table.sort_by("begin")
    w, s = t.column("w").to_numpy(), t.column("s").to_numpy()
    block = pooled(w, s)
    value = np.bincount(block, s) / np.bincount(block, w)
    return pa.table({"key": t.column("key"), "begin": t.column("begin"), "value": pa.array(value[block])})


def isotonic_values(df: DataFrame, key: str, score: str, label: str, partitions: int | None = None) -> DataFrame:
    """One row per key and distinct score: key, score, w (rows with a label), value (fitted, not falling in the score).
    Rows without a label only get a value; a key without labels gets null. Null keys and scores take no part."""
    spark = df.sparkSession
    points = (df.where(F.col(score).isNotNull() & F.col(key).isNotNull())
              .groupBy(F.col(key).cast("string").alias("key"), F.col(score).cast("double").alias("score"))
              .agg(F.count(label).cast("double").alias("w"), F.coalesce(F.sum(F.col(label).cast("double")), F.lit(0.0)).alias("s")))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = points.repartitionByRange(n, "key", "score").sortWithinPartitions("key", "score")
    local = ranged.mapInArrow(_local, "key string, score double, w double, s double, begin double")
    local = cut_lineage(local.withColumn("part", F.spark_partition_id()))
    blocks = local.where("w > 0").groupBy("key", "begin").agg(F.sum("w").alias("w"), F.sum("s").alias("s"))
    values = blocks.groupBy("key").applyInArrow(_merged, "key string, begin double, value double")
    # scores ahead of a range's first block belong to the last block of the ranges before: one row a key and range
    ends = local.groupBy("key", "part").agg(F.max("begin").alias("end"), F.min("begin").alias("start"))
    w = Window.partitionBy("key").orderBy("part")
    carried = ends.select("key", "part", F.coalesce(F.last("end", True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                                    F.min("start").over(Window.partitionBy("key"))).alias("before"))
    placed = local.join(carried, ["key", "part"]).withColumn("begin", F.coalesce("begin", "before"))
    return placed.join(values, ["key", "begin"], "left").select("key", "score", F.col("w").cast("long").alias("w"), "value")
