"""Small SQL-text helpers for the DuckDB oracle strings."""

from __future__ import annotations

# The same published erfc coefficients as tabforge.operators.profile.erfc.
ERFC_COEFFS = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
               0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]


def _d(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


def erfc_sql(x: str) -> str:
    z = f"abs({x})"
    t = f"(CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + CAST(0.5 AS DOUBLE) * {z}))"
    poly = _d(ERFC_COEFFS[-1])
    for c in reversed(ERFC_COEFFS[:-1]):
        poly = f"({_d(c)} + {t} * {poly})"
    ans = f"({t} * exp(-{z} * {z} + {poly}))"
    return f"CASE WHEN {x} >= 0 THEN {ans} ELSE CAST(2.0 AS DOUBLE) - {ans} END"


def mode_sql(col: str, src: str) -> str:
    """Most frequent non-null value, ties to the smallest (pandas ``mode()[0]``)."""
    return (f"SELECT {col} FROM (SELECT {col}, count(*) AS c FROM {src} AND {col} IS NOT NULL GROUP BY {col}) "
            f"ORDER BY c DESC, {col} LIMIT 1") if " WHERE " in f" {src} " else (
        f"SELECT {col} FROM (SELECT {col}, count(*) AS c FROM {src} WHERE {col} IS NOT NULL GROUP BY {col}) "
        f"ORDER BY c DESC, {col} LIMIT 1")
