"""Readers and writers: parquet test tables, CSV landing files, HTML links."""
