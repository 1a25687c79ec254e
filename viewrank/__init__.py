"""Most-viewed-item analytics on Spark: counts per time bucket, exact top-K, streaming."""
