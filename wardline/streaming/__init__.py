"""Incremental file-drop ingestion and entity resolution with Structured Streaming."""
from wardline.streaming.filedrop import csv_stream, ingest
from wardline.streaming.resolve import resolve_stream

__all__ = ["csv_stream", "ingest", "resolve_stream"]
