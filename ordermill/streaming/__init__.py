"""Structured Streaming forms of the bronze and silver steps, and incremental gold tables."""
