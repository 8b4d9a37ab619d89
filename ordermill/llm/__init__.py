"""Operators that prepare text corpora: filtering, near duplicates, scans, counts, search and mixing."""
