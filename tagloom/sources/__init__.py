"""Readers: parquet tables, text lines, message topics, JSON items, pages."""
