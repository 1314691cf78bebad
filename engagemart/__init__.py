"""Brand-engagement analytics on Spark: staging, quality checks, loads and marts."""
