"""Repeated batch loads driven by Structured Streaming."""
