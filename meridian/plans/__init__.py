"""Composite jobs: staging (ingest/reshape), star schema, checks, analyses."""
