"""All queries of the core package and the SQL that gives the same rows."""

from __future__ import annotations

from worktally.plans import change_queries, record_oracles, record_queries, works_oracles, works_queries

_QUERIES = [change_queries, works_queries, record_queries]
_ORACLES = [change_queries, works_oracles, record_oracles]

#: The query of the smoke check.
FLAGSHIP = "competition_rank"


def queries() -> dict:
    """Query functions by name."""
    return {name: f for m in _QUERIES for name, f in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    """SQL by query name, where SQL can express the query."""
    return {name: sql for m in _ORACLES for name, sql in m.ORACLES.items()}
