"""Varve: table ingest and versioning as Spark jobs."""
