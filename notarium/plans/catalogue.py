"""All queries of the core with their SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ["corpus", "vocabulary", "quality", "lines", "similar", "documents", "build", "review", "streams", "audit", "files"]
QUERIES: dict = {}
SQL: dict[str, str] = {}
for _name in MODULES:
    _m = import_module(f"notarium.plans.{_name}")
    QUERIES |= _m.QUERIES
    SQL |= _m.SQL
FLAGSHIP = "a1_exact_dups"
