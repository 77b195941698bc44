"""Structured Streaming forms of scoring and drift."""
