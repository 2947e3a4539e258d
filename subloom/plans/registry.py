"""Where queries and their SQL are kept by name."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def keep(f):
        if f.__name__ in QUERIES:
            raise ValueError(f"two queries are named {f.__name__}")
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep
