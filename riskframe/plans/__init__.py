"""Registered queries over the provided test tables and their DuckDB oracle SQL."""
