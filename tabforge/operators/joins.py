"""Lookup joins: counts, dictionaries, rule tables with fallback chains,
best-match (range-fit) joins, pair self-joins and 1-row scalar attachment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.operators.common import as_list, checked_broadcast


def count_lookup(df: DataFrame, key: str, out: str = "key_count", source: DataFrame | None = None) -> DataFrame:
    """Attach how many rows of ``source`` (default ``df``) share the key.

    Counts are a partial aggregation (map-side combine) and the join back is
    size-checked; null keys get a null count.
    """
    src = df if source is None else source
    counts = src.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return df.join(checked_broadcast(counts), key, "left")


def dict_lookup(df: DataFrame, col: str, mapping: Mapping | DataFrame, out: str,
                default=None, value_col: str = "value") -> DataFrame:
    """Map values through a dictionary; unmapped -> ``default`` (null).

    A literal dict becomes an in-expression ``map`` (no join); a DataFrame
    mapping ``(col, value_col)`` is joined with a size check.
    """
    if isinstance(mapping, DataFrame):
        m = mapping.select(F.col(mapping.columns[0]).alias(col), F.col(value_col).alias(out))
        j = df.join(checked_broadcast(m), col, "left")
        return j if default is None else j.withColumn(out, F.coalesce(F.col(out), F.lit(default)))
    lit_map = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    val = lit_map[F.col(col)]
    if default is not None:
        val = F.coalesce(val, F.lit(default))
    return df.withColumn(out, val)


def rule_fill(df: DataFrame, target: str, levels: Sequence[tuple[Sequence[str], DataFrame]],
              default=None, out: str | None = None, rule_col: str = "value") -> DataFrame:
    """Fill nulls of ``target`` from ordered rule tables.

    ``levels`` is ``[(keys, rules), ...]`` most specific first; each rules
    table holds ``keys + [rule_col]``. A row takes its own value if present,
    else the first level whose keys match (null keys never match), else
    ``default`` (a literal or a 1-row DataFrame holding ``rule_col``).
    """
    out = out or target
    cur = df
    picks: list[Column] = [F.col(target)]
    tmp = []
    for i, (keys, rules) in enumerate(levels):
        keys = as_list(keys)
        name = f"_rule{i}"
        r = rules.select(*keys, F.col(rule_col).alias(name))
        if keys:
            cur = cur.join(checked_broadcast(r), keys, "left")
        else:
            cur = cur.crossJoin(F.broadcast(single_row(r)))
        picks.append(F.col(name))
        tmp.append(name)
    if isinstance(default, DataFrame):
        cur = cur.crossJoin(F.broadcast(single_row(default.select(F.col(rule_col).alias("_rule_d")))))
        picks.append(F.col("_rule_d"))
        tmp.append("_rule_d")
    elif default is not None:
        picks.append(F.lit(default))
    return cur.withColumn(out, F.coalesce(*picks)).drop(*tmp)


def single_row(df: DataFrame) -> DataFrame:
    """The one row of ``df`` (nulls if it has none); a second row is an error, not an arbitrary pick."""
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.first(c).alias(c) for c in df.columns])
    return one.select(*[F.when(F.col("_rows") <= 1, F.col(c)).otherwise(
        F.raise_error(F.lit(f"more than one row where a single {c} is expected"))).alias(c) for c in df.columns])


def with_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Attach the columns of a 1-row DataFrame to every row."""
    return df.crossJoin(F.broadcast(single_row(scalars)))


def best_match(df: DataFrame, id_col: str, target: str, on: Sequence[str], value: str,
               candidates: DataFrame, cand_key: str, score: Column,
               out: str | None = None, higher_is_better: bool = False,
               keep: Column | None = None) -> DataFrame:
    """For rows with null ``target`` choose, among candidate rows sharing
    ``on``, the one with the best ``score``; ties go to the smallest key.

    ``candidates`` holds ``on + [cand_key] + range columns``; ``score`` is an
    expression over the row's ``value`` and the candidate's columns;
    ``keep`` optionally filters admissible candidates. Rows with no admissible
    candidate keep null. Only null-target rows probe, and each probe meets the
    candidates of its own class (a bounded rules table), so this is an
    equi join plus a per-row arg-min, never a cross product of data rows.
    """
    out = out or target
    on = as_list(on)
    rid = id_col
    base = df
    probe = base.where(F.col(target).isNull() & F.col(value).isNotNull()).select(rid, *on, value)
    cands = checked_broadcast(candidates)
    j = probe.join(cands, on)
    if keep is not None:
        j = j.where(keep)
    sc = score if not higher_is_better else -score
    best = (j.withColumn("_bm_s", sc)
             .groupBy(rid).agg(F.min(F.struct(F.col("_bm_s"), F.col(cand_key).alias("k"))).alias("_bm")))
    best = best.select(rid, F.col("_bm.k").alias("_bm_pick"))
    res = base.join(best, rid, "left").withColumn(out, F.coalesce(F.col(target), F.col("_bm_pick")))
    return res.drop("_bm_pick")


def pair_join(long_df: DataFrame, id_col: str, item_col: str, cols: Sequence[str],
              items: Sequence[str] | None = None) -> DataFrame:
    """Unordered pairs of items per id (``a.item < b.item``).

    Equi join on the id, theta on the item: each id meets only its own k
    items (k models), never all ids.
    """
    cols = as_list(cols)
    src = long_df if items is None else long_df.where(F.col(item_col).isin(list(items)))
    a = src.select(id_col, F.col(item_col).alias("item_a"), *[F.col(c).alias(f"{c}_a") for c in cols])
    b = src.select(id_col, F.col(item_col).alias("item_b"), *[F.col(c).alias(f"{c}_b") for c in cols])
    return a.join(b, id_col).where(F.col("item_a") < F.col("item_b"))


def column_pairs(cols: Sequence[str]) -> list[tuple[str, str]]:
    """i<j pairs of column names (a bounded list from the schema)."""
    cols = list(cols)
    return [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]


def top_n_per_group(df: DataFrame, keys, order: Sequence[Column], n: int = 1,
                    salts: int = 64, salt_by: Sequence[str] | None = None) -> DataFrame:
    """first ``n`` rows per group under ``order`` (a total order).

    Two phases so that a hot group is never ranked in one task: rank inside
    (group, salt) and keep ``n``, then rank the at most ``salts * n``
    survivors per group. ``salt_by`` names columns hashed into the salt
    (default: all columns).
    """
    keys = as_list(keys)
    cols = list(salt_by) if salt_by else df.columns
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*cols), F.lit(salts)))
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    pre = salted.withColumn("_rn", F.row_number().over(w1)).where(F.col("_rn") <= n)
    w2 = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
    return pre.withColumn("_rn", F.row_number().over(w2)).where(F.col("_rn") <= n).drop("_rn", "_salt")
