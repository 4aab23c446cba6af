"""Structured Streaming jobs: routed file ingest, incremental KPIs and threshold alarms."""
