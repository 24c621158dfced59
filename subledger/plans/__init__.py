"""Composite reports, the end-to-end job, the registered driver queries and their
DuckDB oracle SQL."""
