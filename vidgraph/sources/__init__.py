"""Readers and writers: crawl folders, CSV, Parquet and format passthrough."""
