"""Composed plans: table catalog, registered queries and their DuckDB oracle SQL."""
