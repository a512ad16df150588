"""Query registry (Spark) and its DuckDB oracle."""
