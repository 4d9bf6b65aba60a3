"""Query registry, DuckDB oracle SQL and the model-building pipeline."""
