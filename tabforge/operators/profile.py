"""Missingness and relationship profiling."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.operators.common import safe_corr
from tabforge.operators.joins import column_pairs


def erfc(x: Column) -> Column:
    """Complementary error function, fractional error < 1.2e-7 (the
    Chebyshev-fitted rational form published in Numerical Recipes)."""
    z = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * z)
    # Published coefficients, highest order last.
    coeffs = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
              0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
    poly = F.lit(coeffs[-1])
    for c in reversed(coeffs[:-1]):
        poly = F.lit(c) + t * poly
    ans = t * F.exp(-z * z + poly)
    return F.when(x >= 0, ans).otherwise(F.lit(2.0) - ans)


def chi2_yates(a: Column, b: Column, c: Column, d: Column) -> tuple[Column, Column]:
    """K5: Yates-corrected chi-square of a 2x2 table [[a, b], [c, d]] and its
    p-value (1 dof): p = erfc(sqrt(chi2 / 2))."""
    a, b, c, d = [x.cast("double") for x in (a, b, c, d)]
    n = a + b + c + d
    num = n * F.pow(F.greatest(F.abs(a * d - b * c) - n / F.lit(2.0), F.lit(0.0)), 2)
    den = (a + b) * (c + d) * (a + c) * (b + d)
    chi2 = F.when(den > 0, num / den)
    return chi2, erfc(F.sqrt(chi2 / F.lit(2.0)))


def missing_summary(df: DataFrame, cols: Sequence[str] | None = None, only_missing: bool = True) -> DataFrame:
    """``(column, n_missing, pct)`` in one pass; pct to 2 dp."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_missing")) for c in cols]))
    out = wide.select("_rows", st.alias("s")).select(
        "s.column", "s.n_missing", F.round(F.col("s.n_missing") * F.lit(100.0) / F.col("_rows"), 2).alias("pct"))
    return out.where(F.col("n_missing") > 0) if only_missing else out


def missing_impact(df: DataFrame, cols: Sequence[str], label: str, alpha: float = 0.05) -> DataFrame:
    """Label rate when missing vs present per column, difference,
    counts, Yates chi-square p and a significance flag; one pass."""
    aggs = []
    y = F.col(label).cast("double")
    for c in cols:
        m = F.col(c).isNull()
        aggs += [F.count(F.when(m, 1)).alias(f"{c}|nm"), F.sum(F.when(m, y)).alias(f"{c}|pm"),
                 F.count(F.when(~m, 1)).alias(f"{c}|np"), F.sum(F.when(~m, y)).alias(f"{c}|pp")]
    wide = df.agg(*aggs)
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}|nm`").alias("n_missing"),
                                      F.coalesce(F.col(f"`{c}|pm`"), F.lit(0.0)).alias("pos_missing"),
                                      F.col(f"`{c}|np`").alias("n_present"),
                                      F.coalesce(F.col(f"`{c}|pp`"), F.lit(0.0)).alias("pos_present")) for c in cols]))
    x = wide.select(st.alias("s")).select("s.*")
    rm = F.try_divide("pos_missing", "n_missing")
    rp = F.try_divide("pos_present", "n_present")
    chi2, p = chi2_yates(F.col("pos_missing"), F.col("n_missing") - F.col("pos_missing"),
                         F.col("pos_present"), F.col("n_present") - F.col("pos_present"))
    return x.select("column", "n_missing", "n_present", F.round(rm, 6).alias("rate_missing"),
                    F.round(rp, 6).alias("rate_present"), F.round(rm - rp, 6).alias("diff"),
                    F.round(chi2, 6).alias("chi2"), F.round(p, 6).alias("p_value"),
                    F.coalesce(p < alpha, F.lit(False)).cast("int").alias("significant")
                    ).where(F.col("n_missing") > 0)


def correlations(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """K1: Pearson correlation of every i<j pair (pairwise complete) in one
    aggregation, long form ``(f1, f2, corr)``."""
    pairs = column_pairs(cols)
    wide = df.agg(*[safe_corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    st = F.explode(F.array(*[F.struct(F.lit(a).alias("f1"), F.lit(b).alias("f2"),
                                      F.round(F.col(f"`{a}|{b}`"), digits).alias("corr")) for a, b in pairs]))
    return wide.select(st.alias("s")).select("s.*")


def _moments(df: DataFrame, cols: Sequence[str], centred: bool) -> np.ndarray:
    """k x k correlation (centred) or raw cross-product (uncentred) matrix from
    one aggregation over complete rows; the k x k result is the only thing the
    driver sees."""
    k = len(cols)
    full = df
    for c in cols:
        full = full.where(F.col(c).isNotNull())
    if centred:
        exprs = [safe_corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"m{i}_{j}")
                 for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]
        exprs += [(F.min(c) < F.max(c)).alias(f"varies{i}") for i, c in enumerate(cols)]  # merged deviations of a constant need not be 0
    else:
        exprs = [F.sum(F.col(a).cast("double") * F.col(b).cast("double")).alias(f"m{i}_{j}")
                 for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j]
    row = full.agg(*exprs).first().asDict()
    m = np.eye(k)
    for i in range(k):
        for j in range(k):
            if i < j or (i == j and not centred):
                v = row[f"m{i}_{j}"]
                if centred and not (row[f"varies{i}"] and row[f"varies{j}"]):
                    v = None
                m[i, j] = m[j, i] = np.nan if v is None else v
    return m


#: From this share of explained variance on, a feature counts as a combination of the others.
FULL_R2 = 0.9999


def _inflation(r: np.ndarray, j: int) -> float:
    """1 / (1 - R^2) of column ``j`` on the others of a correlation matrix; infinity from ``FULL_R2`` on."""
    others = [i for i in range(len(r)) if i != j]
    if not others:
        return 1.0
    explained = float(r[j, others] @ np.linalg.pinv(r[np.ix_(others, others)], rcond=1e-12, hermitian=True) @ r[others, j])
    return float("inf") if explained >= FULL_R2 else 1.0 / (1.0 - max(explained, 0.0))


def vif(df: DataFrame, cols: Sequence[str], centred: bool = True, cap: float | None = None) -> DataFrame:
    """Variance inflation factors.

    Centred: 1/(1-R_j^2) from the correlation matrix, infinity where R_j^2 reaches 0.9999, for that feature alone; a
    constant feature is infinite and takes no part in the others. Uncentred: diag(X'X) * diag(inv(X'X)), infinite where
    singular. ``cap`` bounds the values.
    """
    m = _moments(df, cols, centred)
    if centred:
        flat = [bool(np.isnan(m[j, [i for i in range(len(m)) if i != j]]).all()) and len(m) > 1 for j in range(len(m))]
        live = [j for j in range(len(m)) if not flat[j]]
        sub = np.nan_to_num(m[np.ix_(live, live)])
        vals = [float("inf") if flat[j] else _inflation(sub, live.index(j)) for j in range(len(m))]
    else:
        try:
            vals = [float(v) if np.isfinite(v) and v >= 0 else float("inf") for v in np.diag(m) * np.diag(np.linalg.inv(m))]
        except np.linalg.LinAlgError:
            vals = [float("inf")] * len(cols)
    out = [(c, v if cap is None else min(v, cap)) for c, v in zip(cols, vals, strict=True)]
    return df.sparkSession.createDataFrame(out, "feature string, vif double")


def eliminate_collinear(df: DataFrame, cols: Sequence[str], limit: float = 10.0) -> DataFrame:
    """The feature of the largest VIF goes until none exceeds ``limit``; of equal ones the later in ``cols``.

    feature, step (when it went; 0: stays), vif (when it went, or at the end), action. One aggregation; each step drops
    a row and column of the correlation matrix.
    """
    m = _moments(df, cols, True)
    flat = [j for j in range(len(m)) if len(m) > 1 and np.isnan(m[j, [i for i in range(len(m)) if i != j]]).all()]
    rows, step = [], 0
    for j in flat:  # constants explain nothing
        step += 1
        rows.append((cols[j], step, float("inf"), "drop"))
    left = [j for j in range(len(m)) if j not in flat]
    r = np.nan_to_num(m)
    while left:
        values = [_inflation(r[np.ix_(left, left)], i) for i in range(len(left))]
        worst = max(range(len(left)), key=lambda i: (values[i], i))
        if values[worst] <= limit:
            rows += [(cols[j], 0, v, "keep") for j, v in zip(left, values, strict=True)]
            break
        step += 1
        rows.append((cols[left.pop(worst)], step, values[worst], "drop"))
    return df.sparkSession.createDataFrame(rows, "feature string, step int, vif double, action string")
