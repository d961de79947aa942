"""Queries by name, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its own name, and the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        name = f.__name__
        if name in _QUERIES:
            raise ValueError(f"two queries are called {name}")
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


def _load() -> None:
    """Importing these modules registers their queries."""
    from .operators import checks, columns, documents, intervals, invariants, ledger, loaders, options, parties, payroll, printed, relational, required, scalars  # noqa: F401
    from .plans import batches, catalog, dataset, parts, planner, publish  # noqa: F401
    from .sources import contracts  # noqa: F401
    from .streaming import events  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
