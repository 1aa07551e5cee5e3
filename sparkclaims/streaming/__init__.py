"""Structured Streaming sources, transformations and sinks."""
