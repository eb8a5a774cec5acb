"""Readers: landing JSON streams, parquet tables, fixed schemas."""
