"""Named batch steps, the query registry and the DuckDB oracle SQL."""
