"""All queries of this subpackage with their SQL."""

from __future__ import annotations

from . import forest, languages, lookalike, markup, mixing, near, packing, pieces, repeats, sentences

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _m in (forest, languages, lookalike, markup, mixing, near, packing, pieces, repeats, sentences):
    QUERIES |= _m.QUERIES
    SQL |= _m.SQL
