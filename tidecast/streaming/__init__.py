"""Structured Streaming versions of the scoring plans (file sources and sinks only)."""
