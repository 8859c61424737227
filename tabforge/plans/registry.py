"""Registry of named queries and their DuckDB oracle SQL.

``@query(name, sql)`` registers a callable ``(spark, sf_dir) -> DataFrame``.
The oracle SQL may refer to the derived views ``base`` and ``scores``; the
matching CTEs are prepended automatically.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from tabforge.plans.fixtures import BASE_SQL, SCORES_SQL, SEEDED_SQL

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

_VIEWS = {"base": BASE_SQL, "scores": SCORES_SQL, "seeded": SEEDED_SQL}


def with_views(sql: str) -> str:
    needed = [v for v in _VIEWS if re.search(rf"\b(FROM|JOIN)\s+{v}\b", sql, re.I)]
    if "seeded" in needed and "scores" not in needed:
        needed.insert(0, "scores")
    if not needed:
        return sql
    ctes = ",\n".join(f"{v} AS ({_VIEWS[v]})" for v in needed)
    body = sql.strip()
    if re.match(r"WITH\s+RECURSIVE\s", body, re.I):
        return f"WITH RECURSIVE {ctes},\n{re.split(r'RECURSIVE', body, maxsplit=1, flags=re.I)[1].lstrip()}"
    if re.match(r"WITH\s", body, re.I):
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return fn
    return deco


def load_all() -> None:
    """Import every query module so that its decorators run."""
    import importlib
    for mod in MODULES:
        importlib.import_module(f"tabforge.plans.{mod}")


MODULES = ["q_flagship", "q_relational", "q_groups", "q_scalar", "q_encode", "q_impute", "q_metrics",
           "q_ensemble", "q_stats", "q_folds", "q_io", "q_models", "q_stream", "q_knn"]
