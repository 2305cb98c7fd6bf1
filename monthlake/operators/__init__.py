"""DataFrame -> DataFrame operators: dedup, upsert, quality checks, serving."""
