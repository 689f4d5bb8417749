"""Readers: parquet table dirs, CSV with dialect sniffing and typing, workbooks, file routing."""
