"""The queries of the text and label operators and the SQL that gives the same rows."""

from __future__ import annotations

import importlib

#: Modules with QUERIES and ORACLES.
MODULES = ("mapping_queries", "percentile_queries", "name_queries", "token_queries", "language_queries")


def _loaded():
    return [importlib.import_module(f"worktally.llm.{m}") for m in MODULES]


def queries() -> dict:
    """Query functions by name."""
    return {name: f for m in _loaded() for name, f in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    """SQL by query name, where SQL can express the query."""
    return {name: sql for m in _loaded() for name, sql in m.ORACLES.items()}
