"""How query modules register queries and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable


def registry() -> tuple[dict, dict, Callable]:
    """(queries, oracles, decorator): decorator(name, sql) adds a query and, if given, its SQL."""
    queries: dict = {}
    oracles: dict = {}

    def query(name: str, sql: str | None = None):
        def add(f):
            queries[name] = f
            if sql:
                oracles[name] = sql
            return f

        return add

    return queries, oracles, query
