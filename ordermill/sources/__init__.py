"""Readers and writers; connection details always come from the caller."""
