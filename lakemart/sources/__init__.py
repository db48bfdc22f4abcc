"""Readers for landed files, catalogue snapshots and written tables."""
