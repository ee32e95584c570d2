"""All registered queries and their DuckDB twins."""

from __future__ import annotations

import importlib

_MODULES = (
    "quaystone.plans.q_revenue",
    "quaystone.plans.q_contracts",
    "quaystone.plans.q_worktime",
    "quaystone.plans.q_history",
    "quaystone.plans.q_tickets",
    "quaystone.plans.q_sampling",
    "quaystone.plans.q_sources",
    "quaystone.plans.q_streaming",
    "quaystone.plans.q_records",
    "quaystone.plans.q_jobs",
)


def _load():
    queries, sql = {}, {}
    for name in _MODULES:
        mod = importlib.import_module(name)
        dup = set(queries) & set(mod.QUERIES)
        if dup:
            raise RuntimeError(f"duplicate query names: {dup}")
        queries.update(mod.QUERIES)
        sql.update(getattr(mod, "SQL", {}))
    return queries, sql


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
