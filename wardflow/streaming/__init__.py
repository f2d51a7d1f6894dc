"""Streaming ingest of message files into the segment tables."""
