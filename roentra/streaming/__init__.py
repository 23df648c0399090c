"""Structured Streaming forms of the event and alert jobs."""
