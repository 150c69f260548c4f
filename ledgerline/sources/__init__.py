"""Readers: Parquet tables, JSON and XML documents."""
