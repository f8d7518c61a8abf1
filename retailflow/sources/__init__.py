"""Readers and writers: CSV bronze files, Parquet zones, wire records, streams."""
