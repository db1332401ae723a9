"""Registered queries over the test tables, each with its DuckDB oracle SQL.

Every query reads the given tables (or frames Spark derives from them), so its
work grows with the data. ``catalog.queries()`` / ``catalog.oracle_sql()`` collect
the per-domain registries.
"""
