"""Structured Streaming over landed files."""
