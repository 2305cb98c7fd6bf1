"""Sources and sinks: raw text/parquet ingest, period layout, listing catalog, manifests."""
