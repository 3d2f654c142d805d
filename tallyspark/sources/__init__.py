"""Readers for the pipe-delimited filings, upsert, schemas and sinks."""
