"""Daily price bars on Spark: ingest, layered enrichment, trend forecasts."""
