"""Checks against DuckDB: derived source tables, registered queries, oracle SQL."""
