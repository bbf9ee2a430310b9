"""All registered queries."""

from __future__ import annotations

from vitrine.plans import queries_checks, queries_ml, queries_products, queries_rules, queries_stats, queries_text
from vitrine.plans.registry import Query

MODULES = (queries_products, queries_stats, queries_rules, queries_text, queries_ml, queries_checks)


def queries() -> dict[str, Query]:
    return {k: v for m in MODULES for k, v in m.REG.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.REG.oracles.items()}
