"""DuckDB oracle texts: every model as a named CTE over the driver views.

``compose(select_sql)`` prefixes a final SELECT with exactly the CTEs it
needs (found by name, transitively), in definition order.
"""

from __future__ import annotations

import re

from tokenledger.oracle.feeds_sql import CTES


def _load_all() -> None:
    from tokenledger.oracle import marts_sql, models_sql, quality_sql, semantic_sql  # noqa: F401


def _refs(text: str) -> set[str]:
    return {n for n in CTES if re.search(rf"\b{re.escape(n)}\b", text)}


def compose(select_sql: str) -> str:
    _load_all()
    ordered: list[str] = []
    seen: set[str] = set()

    def visit(n: str) -> None:
        if n in seen:
            return
        seen.add(n)
        for d in sorted(_refs(CTES[n]) - {n}):
            visit(d)
        ordered.append(n)

    for n in sorted(_refs(select_sql)):
        visit(n)
    if not ordered:
        return select_sql
    body = ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in ordered)
    if select_sql.lstrip().upper().startswith("WITH"):
        select_sql = f"SELECT * FROM (\n{select_sql}\n) q"
    return f"WITH {body}\n{select_sql}"
