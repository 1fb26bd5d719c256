"""Continuous ingest into a change log and bucketed current tables."""
