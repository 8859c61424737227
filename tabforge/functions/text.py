"""String column functions (all JVM-side expressions, no UDFs)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Title pattern of the reference (a word followed by a dot,
# preceded by a space).
TITLE_PATTERN = r" ([A-Za-z]+)\."


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def extract_first(col: str | Column, pattern: str, group: int = 1) -> Column:
    """H1: first regex group; no match -> null (not '')."""
    return F.nullif(F.regexp_extract(_c(col), pattern, group), F.lit(""))


def title(col: str | Column, pattern: str = TITLE_PATTERN) -> Column:
    return extract_first(col, pattern)


def first_char(col: str | Column, missing: str | None = None) -> Column:
    """H2: first character; null stays null or becomes ``missing``."""
    ch = F.substring(_c(col), 1, 1)
    return ch if missing is None else F.coalesce(ch, F.lit(missing))


def str_len(col: str | Column) -> Column:
    """H3"""
    return F.length(_c(col))


def prefix_class(col: str | Column) -> Column:
    """H4: normalise the non-numeric prefix of a code.

    Stripped value; if what remains after removing dots is all digits ->
    'NUMERIC'; if it starts with letters/dots/slashes/spaces -> that run with
    runs of [./ whitespace] turned into '_', '_' trimmed, upper-cased; else
    'OTHER' (also for empty strings).
    """
    s = F.trim(_c(col))
    lead = F.regexp_extract(s, r"^([A-Za-z./\s]+)", 1)
    norm = F.upper(F.regexp_replace(F.regexp_replace(lead, r"[./\s]+", "_"), r"^_+|_+$", ""))
    return (F.when(s.isNull(), F.lit(None))
            .when(F.regexp_replace(s, r"\.", "").rlike(r"^[0-9]+$"), F.lit("NUMERIC"))
            .when(F.length(lead) > 0, norm)
            .otherwise(F.lit("OTHER")))


def first_int(col: str | Column, default: int = 0) -> Column:
    """H5: first run of digits as a long, else ``default``."""
    return F.coalesce(extract_first(col, r"(\d+)").cast("long"), F.lit(default).cast("long"))


def replace_values(col: str | Column, values: Iterable, replacement) -> Column:
    """H6: values in the list become ``replacement``; others unchanged."""
    c = _c(col)
    return F.when(c.isin(list(values)), F.lit(replacement)).otherwise(c)


def concat_keys(*cols: str | Column, sep: str = "_") -> Column:
    """H7: ``a + sep + b`` with pandas null semantics (any null -> null)."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_c(c).cast("string"))
    return F.concat(*parts)


def percent_text(col: str | Column, decimals: int = 1) -> Column:
    """H9: ratio in [0,1] formatted as a percentage string."""
    return F.format_string(f"%.{decimals}f%%", _c(col) * F.lit(100.0))
