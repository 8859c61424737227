"""Distributed exact ranking and running sums.

A plain ``row_number()`` over a window partitioned only by a low-cardinality
column (a 0/1 label, a model name) sends half the data to one task. Here the
order key is cut by an order-preserving ``bucket`` into many ranges; per
(partition, bucket) counts form a small table whose prefix sums are the
offsets; ranks are computed inside (partition, bucket) and shifted by the
offset. The result is identical to the plain window.

``bucketed_row_number`` takes a bucket known to be even (a hash prefix); keys of
unknown shape go through ``range_row_number``, whose ranges are cut by splitters
sampled from the whole sort key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.operators.common import as_list, checked_broadcast
from tabforge.operators.quantiles import value_bucket
from tabforge.session import cut_lineage

#: ``monotonically_increasing_id`` keeps the partition above these bits and the row's place in it below.
_PLACE_BITS = 33


def hex_prefix_bucket(col: str | Column, chars: int = 4) -> Column:
    """Order-preserving bucket of a lowercase hex string (e.g. an md5)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.conv(F.substring(c, 1, chars), 16, 10).cast("long")


def _renamed(offs: DataFrame, part: list[str]) -> DataFrame:
    return offs.withColumnsRenamed({c: f"_o{i}_" for i, c in enumerate([*part, "_bk"])})


def _null_safe(x: DataFrame, offs: DataFrame, part: list[str]) -> DataFrame:
    """Join offsets so that null partition keys and null order keys keep their rows."""
    names = [*part, "_bk"]
    on = F.lit(True)
    for i, c in enumerate(names):
        on = on & x[c].eqNullSafe(offs[f"_o{i}_"])
    return x.join(offs, on).drop(*[f"_o{i}_" for i in range(len(names))])


def bucketed_row_number(df: DataFrame, partition: Sequence[str] | str | None,
                        order: Sequence[Column], bucket: Column, name: str = "rn",
                        max_broadcast_rows: int = 2_000_000) -> DataFrame:
    """``row_number() over (partition by P order by O)`` computed per bucket.

    ``bucket`` must be monotone non-decreasing in ``order``'s first key and
    ``order`` must be a total order (add the row key as a tie-break).
    """
    part = as_list(partition)
    x = df.withColumn("_bk", bucket)
    counts = x.groupBy(*part, "_bk").agg(F.count(F.lit(1)).alias("_bn"))
    w = (Window.partitionBy(*part) if part else Window.partitionBy()).orderBy("_bk")
    offs = counts.select(*part, "_bk", F.coalesce(
        F.sum("_bn").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    x = _null_safe(x, checked_broadcast(_renamed(offs, part), max_broadcast_rows), part)
    wi = Window.partitionBy(*part, "_bk").orderBy(*order)
    return x.withColumn(name, F.row_number().over(wi) + F.col("_off")).drop("_bk", "_off")


def sorted_ranges(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` in sorted ranges, one a task, with ``_range`` (ascending along ``order``) and ``_place`` (from 0).

    The splitters are sampled from the full composite key, so that neither long
    shared prefixes nor equal leading columns crowd one task. The ranges are
    written, because a range computed again could be cut elsewhere.
    """
    x = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_range_at", F.monotonically_increasing_id())
    x = cut_lineage(x)
    return (x.withColumn("_range", F.shiftright("_range_at", _PLACE_BITS))
            .withColumn("_place", F.col("_range_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))).drop("_range_at"))


def range_row_number(df: DataFrame, order: Sequence[Column], name: str = "rn",
                     partition: Sequence[str] | str | None = None) -> DataFrame:
    """``row_number() over (partition by P order by O)`` from sampled ranges of (P, O).

    ``order`` must be a total order within P. A row's place in its range plus the
    rows of earlier ranges is its rank; the table of ranges has one row a task.
    With ``partition`` the rank of P's first row is subtracted, so a huge P is
    spread over many ranges and many small ones share a range.
    """
    part = as_list(partition)
    x = sorted_ranges(df, [*[F.col(c) for c in part], *order])
    before = Window.orderBy("_range_of").rowsBetween(Window.unboundedPreceding, -1)
    offs = (x.groupBy(F.col("_range").alias("_range_of")).agg(F.count(F.lit(1)).alias("_range_n"))
            .select("_range_of", F.coalesce(F.sum("_range_n").over(before), F.lit(0)).alias("_range_off")))
    x = (x.join(F.broadcast(offs), F.col("_range") == F.col("_range_of"))
         .withColumn(name, F.col("_range_off") + F.col("_place") + 1).drop("_range", "_place", "_range_of", "_range_off"))
    if not part:
        return x
    first = x.groupBy(*[F.col(c).alias(f"_o{i}_") for i, c in enumerate(part)]).agg(F.min(name).alias("_first_rn"))
    on = F.lit(True)
    for i, c in enumerate(part):
        on = on & F.col(c).eqNullSafe(F.col(f"_o{i}_"))
    return (x.join(first, on).withColumn(name, F.col(name) - F.col("_first_rn") + 1)
            .drop("_first_rn", *[f"_o{i}_" for i in range(len(part))]))


def bucketed_running_sum(df: DataFrame, partition: Sequence[str] | str | None, order_col: str,
                         values: Sequence[str], descending: bool = False,
                         prefix: str = "cum_") -> DataFrame:
    """Running sums of ``values`` over ``order_col`` (distinct per partition),
    inclusive of the current row, computed per value bucket plus offsets."""
    part = as_list(partition)
    vals = list(values)
    sign = -1.0 if descending else 1.0
    key = F.col(order_col).cast("double") * F.lit(sign)
    x = df.withColumn("_bk", value_bucket(key, 4096))
    tot = x.groupBy(*part, "_bk").agg(*[F.sum(v).alias(f"_t_{v}") for v in vals])
    w = (Window.partitionBy(*part) if part else Window.partitionBy()).orderBy("_bk")
    frame = w.rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*part, "_bk", *[F.coalesce(F.sum(f"_t_{v}").over(frame), F.lit(0)).alias(f"_o_{v}")
                                      for v in vals])
    x = _null_safe(x, checked_broadcast(_renamed(offs, part)), part)
    ordc = F.col(order_col).desc() if descending else F.col(order_col).asc()
    wi = Window.partitionBy(*part, "_bk").orderBy(ordc).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumns({f"{prefix}{v}": F.sum(v).over(wi) + F.col(f"_o_{v}") for v in vals})
    return x.drop("_bk", *[f"_o_{v}" for v in vals])


def dense_ids(df: DataFrame, key: str, order_by: str, name: str = "code", start: int = 0) -> DataFrame:
    """Factorise ``key`` into consecutive ids in order of first appearance
    (smallest ``order_by``), as a small (key, id) table to join back."""
    first = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order_by).alias("_first"))
    ranked = range_row_number(first, [F.col("_first"), F.col(key)], "_rn")
    return ranked.select(key, (F.col("_rn") - 1 + start).alias(name))
