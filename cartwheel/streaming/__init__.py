"""Structured Streaming forms of the daily aggregates."""
