"""Order analytics on Spark: ingest, curate, count, alert and report."""
