"""Jobs from raw files to the star schema, and the analytic queries on it."""
