"""End-to-end jobs (pipeline) and the query catalog with DuckDB oracles."""
