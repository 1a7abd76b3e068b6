"""All registered queries and their check SQL, by name."""

from __future__ import annotations

import importlib

MODULES = ["url_queries", "page_queries", "product_queries", "catalog_queries", "storage_queries"]


def _collect(attribute: str) -> dict:
    found: dict = {}
    for name in MODULES:
        part = getattr(importlib.import_module(f"webcat.plans.{name}"), attribute)
        assert not found.keys() & part.keys(), "a query name is used twice"
        found.update(part)
    return found


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict:
    return _collect("ORACLE")
