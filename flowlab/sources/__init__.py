"""Readers and writers: CSV captures in, Parquet layers and JSON mappings in and out."""
