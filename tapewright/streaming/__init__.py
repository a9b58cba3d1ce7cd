"""Structured Streaming jobs, sinks and progress reporting."""
