"""Structured Streaming: incremental crawl import."""

from vidgraph.streaming.incremental import crawl_stream, start_incremental_import  # noqa: F401
