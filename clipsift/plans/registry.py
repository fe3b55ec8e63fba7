"""Registered queries: a Spark plan and, where SQL can say it, the same result as plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    plan: Plan
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under its function name."""
    def add(plan: Plan) -> Plan:
        if plan.__name__ in REGISTRY:
            raise ValueError(f"{plan.__name__} is registered twice")
        REGISTRY[plan.__name__] = Query(plan, sql)
        return plan

    return add
