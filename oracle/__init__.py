"""SQL twins of the registered queries, written for DuckDB over the same parquet tables."""
