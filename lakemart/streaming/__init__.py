"""Incremental ingestion of newly landed files."""
