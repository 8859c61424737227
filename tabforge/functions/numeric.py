"""Numeric column helpers: guarded division, exact percent text, stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """Num / den, null when den is 0 or null (instead of inf)."""
    return F.try_divide(_c(num).cast("double"), F.nullif(_c(den).cast("double"), F.lit(0.0)))


def percent_text(num: str | Column, den: str | Column, decimals: int = 1) -> Column:
    """H9: ``num/den`` as a percent string with half-up rounding done in
    integer arithmetic, so the text never depends on binary float ties."""
    scale = 10 ** decimals
    n, d = _c(num).cast("long"), _c(den).cast("long")
    a = F.lit(200 * scale) * n + d
    b = F.lit(2) * d
    units = ((a - F.pmod(a, b)) / b).cast("long")  # exact floor division
    whole = ((units - F.pmod(units, F.lit(scale))) / F.lit(scale)).cast("long")
    frac = units % F.lit(scale)
    return F.concat(whole.cast("string"), F.lit("."), F.lpad(frac.cast("string"), decimals, "0"), F.lit("%"))


def file_stamp(fmt: str = "yyyyMMdd_HHmm") -> Column:
    """Timestamp text for output names."""
    return F.date_format(F.current_timestamp(), fmt)
