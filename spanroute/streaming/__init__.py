"""Structured Streaming over events."""
