"""All registered queries."""

from __future__ import annotations

import importlib

from clipsift.plans.registry import REGISTRY, Query

MODULES = (
    "scalars", "storage", "projections", "relational", "analytics", "ranking", "streams",
    "learning", "composite",
)


def catalog() -> dict[str, Query]:
    for name in MODULES:
        importlib.import_module(f"clipsift.plans.queries.{name}")
    return REGISTRY
