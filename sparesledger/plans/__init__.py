"""Layer wiring (model), the pipeline job, the query registry and the DuckDB oracle."""
