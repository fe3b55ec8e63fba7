"""Queries of this subpackage, by name."""

from __future__ import annotations

from clipsift.plans.registry import Plan, Query

LLM_QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a plan under its function name."""
    def add(plan: Plan) -> Plan:
        if plan.__name__ in LLM_QUERIES:
            raise ValueError(f"{plan.__name__} is registered twice")
        LLM_QUERIES[plan.__name__] = Query(plan, sql)
        return plan

    return add
