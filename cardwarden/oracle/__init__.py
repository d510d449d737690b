"""DuckDB twins of the queries, on the driver's tables."""

from cardwarden.oracle.statements import all_sql

__all__ = ["all_sql"]
