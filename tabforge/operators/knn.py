"""Exact k-nearest-neighbour imputation without an all-pairs join.

Donors (rows of the fit frame with the target observed) are compared with
probes (rows whose target is missing) under Euclidean distance over complete
feature columns; the probe gets the mean target of its k nearest donors (ties
by donor id).

Exactness with bounded candidate sets comes from a 1-D lower bound: for a
unit vector ``u``, |u.(x - y)| <= ||x - y||. ``u`` is proportional to the
features' standard deviations, so the projection follows the widest spread
and distinct vectors practically never tie (a discrete feature alone would).
Donor vectors are de-duplicated into cells (each keeps its first k members by
id, enough for any tie), sorted along ``u`` and cut into equal-count buckets. Round 1 compares each probe
with the cells of its own and neighbouring buckets; the probe is final when
its k-th distance is below the distance along ``a`` to the unsearched cells.
Round 2 searches, for the remaining probes, exactly the buckets whose cells
lie within the k-th distance along ``a``. Positions of probes among cells come
from the bucketed exact ranking, so nothing is sorted in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.operators.joins import top_n_per_group
from tabforge.operators.quantiles import value_bucket
from tabforge.operators.ranking import bucketed_row_number
from tabforge.session import cut_lineage


def _positions(cells: DataFrame, pts: DataFrame, tie: int) -> DataFrame:
    """Number of cells ordered before each point (``pts``: _pid, _s) when a
    point sorts after equal-``_s`` cells (tie=+1) or before them (tie=-1)."""
    u = (cells.select("_s", F.lit(0).alias("_isp"), F.col("cell_id").alias("_k"))
         .unionByName(pts.select("_s", F.lit(tie).alias("_isp"), F.col("_pid").alias("_k"))))
    r = bucketed_row_number(u, None, [F.col("_s"), F.col("_isp"), F.col("_k")], value_bucket(F.col("_s"), 4096), "_R")
    own = bucketed_row_number(pts.select("_pid", "_s"), None, [F.col("_s"), F.col("_pid")],
                              value_bucket(F.col("_s"), 4096), "_Rp")
    r = r.where(F.col("_isp") == tie).select(F.col("_k").alias("_pid"), "_R")
    return own.join(r, "_pid").select("_pid", (F.col("_R") - F.col("_Rp")).alias("_pos"))


def _top_k(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest donors per probe of the nearest of each bucket."""
    x = pairs.select("_pid", F.explode("near").alias("m")).select("_pid", "m._d2", "m.i", "m.t")
    w = Window.partitionBy("_pid").orderBy("_d2", "i")
    return x.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)


def knn_impute(df: DataFrame, donors: DataFrame, id_col: str, target: str, features: Sequence[str], k: int = 5,
               cells_per_bucket: int = 32, window: int = 1, out: str | None = None) -> DataFrame:
    """Fill nulls of ``target`` in ``df`` with the mean target of the k
    nearest donors of ``donors`` (features must be non-null)."""
    out = out or target
    feats = list(features)
    m = int(cells_per_bucket)

    d = donors.where(F.col(target).isNotNull()).select(id_col, F.col(target).cast("double").alias("_t"), *feats)
    first_k = top_n_per_group(d, feats, [F.col(id_col)], n=k, salt_by=[id_col])
    cells = first_k.groupBy(*feats).agg(
        F.array_sort(F.collect_list(F.struct(F.col(id_col).alias("i"), F.col("_t").alias("t")))).alias("members"),
        F.min(id_col).alias("cell_id"))
    var = cells.agg(*[F.var_pop(F.col(c).cast("double")).alias(c) for c in feats]).first()
    sd = [math.sqrt(var[c] or 0.0) for c in feats]
    norm = math.sqrt(sum(v * v for v in sd))
    u = [v / norm for v in sd] if norm > 0 else [1.0] + [0.0] * (len(feats) - 1)

    def proj():
        s = None
        for c, w in zip(feats, u):
            if w:
                term = F.lit(w) * F.col(c).cast("double")
                s = term if s is None else s + term
        return s

    cells = cells.withColumn("_s", proj())
    cells = bucketed_row_number(cells, None, [F.col("_s"), F.col("cell_id")], value_bucket(F.col("_s"), 4096), "_r")
    cells = cut_lineage(cells.withColumn("_bk", F.floor((F.col("_r") - 1) / m)).drop("_r"))
    edges = cells.groupBy("_bk").agg(F.min("_s").alias("_lo"), F.max("_s").alias("_hi"))
    n_bk = edges.agg(F.max("_bk").alias("n")).first()["n"]
    if n_bk is None:  # no donors: nothing to fill from
        return df.withColumn(out, F.col(target))

    probes = df.where(F.col(target).isNull()).select(F.col(id_col).alias("_pid"), *feats, proj().alias("_s"))
    probes = cut_lineage(probes.join(_positions(cells, probes, +1), "_pid"))

    # a bucket is one row, so that a probe's distances stay within it and only its k nearest leave it
    buckets = cells.groupBy("_bk").agg(F.collect_list(F.struct("members", *[F.col(c).cast("double").alias(f"c{j}") for j, c in enumerate(feats)])).alias("cells"))

    def pairs_for(p: DataFrame, bucket_ranges) -> DataFrame:
        """Probe and the k nearest members of each of its buckets."""
        def compared(cell):
            d2 = None
            for j, c in enumerate(feats):
                term = F.pow(F.col(c).cast("double") - cell[f"c{j}"], 2)
                d2 = term if d2 is None else d2 + term
            return F.struct(d2.alias("_d2"), cell["members"].alias("members"))

        def spread(cell):
            return F.transform(cell["members"], lambda m: F.struct(cell["_d2"].alias("_d2"), m["i"].alias("i"), m["t"].alias("t")))

        x = p.select("_pid", *feats, F.explode(bucket_ranges).alias("_bk")).join(buckets, "_bk")
        # the k nearest cells hold the k nearest members: a cell comes with its first member
        first = F.transform("cells", compared)
        first = F.slice(F.sort_array(first), 1, k)
        return x.select("_pid", F.slice(F.sort_array(F.flatten(F.transform(first, spread))), 1, k).alias("near"))

    # round 1: own bucket and neighbours
    b0 = F.floor(F.greatest(F.col("_pos") - 1, F.lit(0)) / m)
    lo_b = F.greatest(b0 - window, F.lit(0))
    hi_b = F.least(b0 + window, F.lit(n_bk))
    p1 = probes.withColumn("_blo", lo_b).withColumn("_bhi", hi_b)
    top1 = _top_k(pairs_for(p1, F.sequence("_blo", "_bhi")), k)
    stat1 = top1.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.max("_d2").alias("_dk2"),
                                     F.avg("t").alias("_mean"))
    e_lo = edges.select(F.col("_bk").alias("_blo"), F.col("_lo").alias("_elo"))
    e_hi = edges.select(F.col("_bk").alias("_bhi"), F.col("_hi").alias("_ehi"))
    chk = (p1.join(stat1, "_pid", "left").join(e_lo, "_blo", "left").join(e_hi, "_bhi", "left"))
    gap_lo = F.when(F.col("_blo") == 0, F.lit(float("inf"))).otherwise(F.col("_s") - F.col("_elo"))
    gap_hi = F.when(F.col("_bhi") == n_bk, F.lit(float("inf"))).otherwise(F.col("_ehi") - F.col("_s"))
    gap = F.least(gap_lo, gap_hi)
    everything = (F.col("_blo") == 0) & (F.col("_bhi") == n_bk)
    # a relative margin keeps float rounding of the projection on the safe side
    done = everything | ((F.col("_n") >= k) & (F.col("_dk2") < gap * gap * F.lit(1.0 - 1e-9)))
    chk = cut_lineage(chk.withColumn("_done", F.coalesce(done, F.lit(False))))
    res1 = chk.where("_done").select("_pid", "_mean")

    # round 2: all buckets within the k-th distance along the axis
    rest = chk.where(~F.col("_done")).select("_pid", *feats, "_s",
                                             (F.sqrt("_dk2") * F.lit(1.0 + 1e-9)).alias("_rad"))
    lo_pts = rest.select("_pid", (F.col("_s") - F.col("_rad")).alias("_s"))
    hi_pts = rest.select("_pid", (F.col("_s") + F.col("_rad")).alias("_s"))
    lo_pos = _positions(cells, lo_pts, -1).withColumnRenamed("_pos", "_plo")
    hi_pos = _positions(cells, hi_pts, +1).withColumnRenamed("_pos", "_phi")
    r2 = rest.join(lo_pos, "_pid").join(hi_pos, "_pid")
    r2 = r2.withColumn("_blo", F.least(F.floor(F.col("_plo") / m), F.lit(n_bk))).withColumn(
        "_bhi", F.least(F.floor(F.greatest(F.col("_phi") - 1, F.lit(0)) / m), F.lit(n_bk)))
    top2 = _top_k(pairs_for(r2, F.sequence("_blo", F.greatest("_blo", "_bhi"))), k)
    res2 = top2.groupBy("_pid").agg(F.avg("t").alias("_mean"))

    fills = res1.unionByName(res2).withColumnRenamed("_pid", id_col)
    return df.join(fills, id_col, "left").withColumn(out, F.coalesce(F.col(target), F.col("_mean"))).drop("_mean")
