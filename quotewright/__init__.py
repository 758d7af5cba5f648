"""Quote analytics on Spark: ingest, curation, reports and quality checks."""
