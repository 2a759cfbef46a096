"""CSV ingest and snapshot tables."""
