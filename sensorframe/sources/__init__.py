"""Sources, sinks, catalog and ingest."""
