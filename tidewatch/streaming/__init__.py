"""Structured Streaming forms, sinks and keyed processors."""
