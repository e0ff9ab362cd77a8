"""The driver's tables seen as movie data, the registered queries, and their DuckDB counterparts."""
