"""How five document filters interact, over every order in which they may run.

Each document gets a mask of the filters it fails. Documents are counted by
part and mask; nothing else about them reaches the audit. A part's at most 32
counts then go through a Gray-code walk over the 32 subsets of filters: each
step toggles one filter, which adds to or takes from the active-failure counter of
every mask cell holding it, and a cell whose counter leaves or reaches zero
moves its documents out of or into the running survivors. The survivors of all
32 states are stored; a step of an order is the difference of two states.

"Identical to a smaller doc_id's text" is decided by SHA-256 of the text.
Rows are reduced to counts by (digest, id, part, mask) before any
join; the join with a text's smallest id is on both digest and id, so a text
with many copies is no hot key.

Defined results: a null text is empty; a null part counts as the empty string.
A row with a null id has no smaller one, is smaller than none, and has no
labels. Repeated rows all count, and none of them is smaller than
another; a label holds if any of the id's label rows says so. A part without
documents does not appear, an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.session import cut_lineage

FILTERS = "ABCDE"


def text_failures(text: Column) -> list[Column]:
    """Filters that look at the text alone, A to D."""
    words = F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != "")
    n_words, n_chars = F.size(words).cast("long"), F.length(text).cast("long")
    n_distinct, n_capitals = F.size(F.array_distinct(words)).cast("long"), F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return [n_words < 100, n_distinct * 100 < n_words * 80, n_capitals * 100 > n_chars * 10, text.rlike(r"[#$%&*|]")]


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   part_col: str = "lang") -> DataFrame:
    """part, mask, n, good, toxic: documents by the filters they fail (bit i of the mask: filter i)."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    bits = [F.when(fails, F.lit(1 << i)).otherwise(F.lit(0)) for i, fails in enumerate(text_failures(F.col("text")))]
    cells = (rows.select("id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
                         (bits[0] + bits[1] + bits[2] + bits[3]).alias("mask"))
             .groupBy("digest", "id", "part", "mask").agg(F.count("*").alias("n")))
    cells = cut_lineage(cells)  # read twice
    first = cells.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id")).withColumn("is_first", F.lit(True))
    judged = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.coalesce(F.col("quality"), F.lit(0)) == 1).cast("int")).alias("good"),
        F.max((F.coalesce(F.col("toxic"), F.lit(0)) == 1).cast("int")).alias("toxic"))
    # a null id meets nothing: the second key only spreads such rows
    spread = F.when(F.col("id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0))
    cells = (cells.withColumn("_spread", spread).join(judged.withColumn("_spread", F.lit(0).cast("long")), ["id", "_spread"], "left")
             .join(first, ["digest", "id"], "left"))
    copy = F.when(F.col("id").isNull() | F.coalesce(F.col("is_first"), F.lit(False)), F.lit(0)).otherwise(F.lit(16))
    good, toxic = (F.col("n") * F.coalesce(F.col(c), F.lit(0)) for c in ("good", "toxic"))
    return cells.groupBy("part", (F.col("mask") + copy).alias("mask")).agg(
        F.sum("n").alias("n"), F.sum(good).alias("good"), F.sum(toxic).alias("toxic"))


def survivors(masks: Sequence[int], counts: np.ndarray, n_filters: int) -> np.ndarray:
    """Row s: sums of ``counts`` over the cells that no filter of subset s fails, by the Gray-code walk."""
    masks = np.asarray(masks, dtype=np.int64)
    failing = np.zeros(len(masks), dtype=np.int64)
    running = counts.sum(axis=0)
    states = np.zeros((1 << n_filters, counts.shape[1]), dtype=np.int64)
    states[0] = running
    active = 0
    for step in range(1, 1 << n_filters):
        bit = step & -step  # the bit in which the step-th Gray code differs from the one before
        holds = (masks & bit) > 0
        if active & bit:
            failing[holds] -= 1
            running = running + counts[holds & (failing == 0)].sum(axis=0)
        else:
            running = running - counts[holds & (failing == 0)].sum(axis=0)
            failing[holds] += 1
        active ^= bit
        states[active] = running
    return states


def order_table(part: str, masks: Sequence[int], counts: np.ndarray, filters: str = FILTERS) -> pd.DataFrame:
    """One row per order of the filters and step, from the stored states."""
    masks = np.asarray(masks, dtype=np.int64)
    states = survivors(masks, counts, len(filters))
    fails = [int(counts[(masks >> i) & 1 == 1, 0].sum()) for i in range(len(filters))]
    alone = [int(counts[masks == 1 << i, 0].sum()) for i in range(len(filters))]
    rows, shapley = [], dict.fromkeys(range(len(filters)), 0)
    for order in permutations(range(len(filters))):
        before = 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            removed, good, toxic = (int(x) for x in states[before] - states[after])
            rows.append((part, "".join(filters[i] for i in order), step, f, int(states[after, 0]), removed, fails[f] - removed,
                         alone[f], good, toxic))
            shapley[f] += removed
            before = after
    table = pd.DataFrame(rows, columns=["part", "filter_order", "step", "f", "kept", "removed", "redundant", "unique_fails",
                                        "good_lost", "toxic_lost"])
    table["shapley"] = table.pop("f").map(shapley)
    return table


SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, "
          "toxic_lost long, shapley long")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the five filters and step; a group holds one part's at most 32 counts."""

    def walk(cells: pd.DataFrame) -> pd.DataFrame:
        counts = cells[["n", "good", "toxic"]].to_numpy(dtype=np.int64)
        return order_table(cells["part"].iloc[0], cells["mask"].to_numpy(), counts).astype({"step": "int32"})

    return failure_counts(docs, labels, id_col, text_col, part_col).groupBy("part").applyInPandas(walk, SCHEMA)


#: The same audit, each state counted from the documents: no walk, no mask cells.
AUDIT_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM d),
l AS (
  SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CAST(len(words) < 100 AS INTEGER) AS fa,
         CAST(100 * len(list_distinct(words)) < 80 * len(words) AS INTEGER) AS fb,
         CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS INTEGER) AS fc,
         CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER) AS fd,
         CAST(coalesce(w.doc_id > first_id, false) AS INTEGER) AS fe
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(letter, bit)),
o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5),
k AS (
  SELECT part, fa + 2 * fb + 4 * fc + 8 * fd + 16 * fe AS mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
s AS (
  SELECT o.filter_order, t.step, f.bit,
         (SELECT coalesce(sum(g.bit), 0) FROM f g WHERE strpos(substr(o.filter_order, 1, t.step - 1), g.letter) > 0) AS before
  FROM o, generate_series(1, 5) AS t(step), f WHERE f.letter = substr(o.filter_order, t.step, 1)),
r AS (
  SELECT k.part, s.filter_order, s.step, s.bit,
         sum(CASE WHEN (k.mask & (s.before | s.bit)) = 0 THEN k.n ELSE 0 END) AS kept,
         sum(CASE WHEN (k.mask & s.before) = 0 AND (k.mask & s.bit) > 0 THEN k.n ELSE 0 END) AS removed,
         sum(CASE WHEN (k.mask & s.before) > 0 AND (k.mask & s.bit) > 0 THEN k.n ELSE 0 END) AS redundant,
         sum(CASE WHEN k.mask = s.bit THEN k.n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN (k.mask & s.before) = 0 AND (k.mask & s.bit) > 0 THEN k.good ELSE 0 END) AS good_lost,
         sum(CASE WHEN (k.mask & s.before) = 0 AND (k.mask & s.bit) > 0 THEN k.toxic ELSE 0 END) AS toxic_lost
  FROM k, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""
