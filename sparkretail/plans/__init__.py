"""Composite builds, the query catalog and the DuckDB oracle texts."""
