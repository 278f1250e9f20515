"""Named queries over the given tables, each with an equivalent SQL text where SQL can say it."""

from tabweave.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
