"""Fixed-edge and quantile binning with pandas ``cut``/``qcut`` semantics.

Bins are returned as 0-based int codes (null when out of range) so that
``category_codes`` (null -> -1) and label lookups compose. Edge lists are
short parameters or a handful of learnt quantiles, so they live in the
expression, not in a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.operators.quantiles import group_quantiles


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def cut(col: str | Column, edges: Sequence[float], right: bool = True,
        include_lowest: bool = False) -> Column:
    """Bin index for ``edges`` (len k+1 -> codes 0..k-1).

    right=True: (e_i, e_i+1]; right=False: [e_i, e_i+1); include_lowest closes
    the first interval on the left. Out of range and null -> null.
    """
    x = _c(col)
    edges = [float(e) for e in edges]
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        if right:
            lower_ok = (x >= F.lit(lo)) if (include_lowest and i == 0) else (x > F.lit(lo))
            cond = lower_ok & (x <= F.lit(hi))
        else:
            upper_ok = (x <= F.lit(hi)) if (include_lowest and i == len(edges) - 2) else (x < F.lit(hi))
            cond = (x >= F.lit(lo)) & upper_ok
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(None).cast("int")) if expr is not None else F.lit(None).cast("int")


def labelled(code: str | Column, labels: Sequence[str]) -> Column:
    """Map bin codes to labels (``cut(..., labels=[...])``)."""
    arr = F.array(*[F.lit(s) for s in labels])
    c = _c(code)
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(F.element_at(arr, c + 1))


def category_codes(code: str | Column) -> Column:
    """``cat.codes`` -> null becomes -1."""
    return F.coalesce(_c(code), F.lit(-1))


def dedupe_edges(edges: Sequence[float | None]) -> list[float]:
    """``duplicates='drop'``: keep distinct ascending edges."""
    out: list[float] = []
    for e in edges:
        if e is None:
            continue
        e = float(e)
        if not out or e > out[-1]:
            out.append(e)
    return out


def quantile_edges(df: DataFrame, col: str, q: int, strategy: str = "auto") -> list[float]:
    """Learn ``q``-quantile edges of ``col`` (exact by default).

    The result is q+1 numbers: a driver-side list bounded by the parameter.
    """
    probs = [i / q for i in range(q + 1)]
    names = [f"e{i}" for i in range(q + 1)]
    row = group_quantiles(df, col, probs, None, names, strategy=strategy).first()
    return dedupe_edges([row[n] for n in names])


def qcut(col: str | Column, edges: Sequence[float]) -> Column:
    """Apply learnt quantile edges, (lo, hi] with the lowest included."""
    return cut(col, edges, right=True, include_lowest=True)


def bucket(col: str | Column, ladder: Sequence[tuple[float, str]], default: str,
           null_label: str | None = None) -> Column:
    """First ``x < bound`` wins -> label, else ``default``; null ->
    ``null_label`` (or ``default`` when not given)."""
    x = _c(col)
    expr = F.when(x.isNull(), F.lit(null_label if null_label is not None else default))
    for bound, lab in ladder:
        expr = expr.when(x < F.lit(bound), F.lit(lab))
    return expr.otherwise(F.lit(default))
