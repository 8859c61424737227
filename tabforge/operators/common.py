"""Small shared helpers: size-checked broadcast, column lists."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Row bound under which a derived table (rules, counts, edges) is broadcast.
DEFAULT_BROADCAST_ROWS = 200_000


def as_list(cols: str | Iterable[str] | None) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows.

    The table is persisted first so that the size check and the join read the
    same materialisation. Beyond the bound the planner is left to choose a
    shuffle join (AQE may still convert it, and splits skewed partitions).
    """
    df = df.persist()
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def null_safe_key_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi join on ``keys`` where null never matches (pandas dict lookup)."""
    return left.join(right, on=list(keys), how=how)


def round_cols(df: DataFrame, cols: Iterable[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def flag(cond: Column) -> Column:
    """Boolean to 0/1 int where a null comparison counts as false."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over pairwise-complete rows that is null (not an
    ANSI divide-by-zero error) when either side is constant."""
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    xm = F.when(y.isNotNull(), x.cast("double"))
    ym = F.when(x.isNotNull(), y.cast("double"))
    den = F.stddev_pop(xm) * F.stddev_pop(ym)
    return F.try_divide(F.covar_pop(xm, ym), F.nullif(den, F.lit(0.0)))
