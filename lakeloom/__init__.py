"""lakeloom: lakehouse ingestion, deduplication, upsert, quality, layout and
governance operators for open-source Spark on plain Parquet."""
