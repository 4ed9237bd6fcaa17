"""Refresh through Structured Streaming."""
