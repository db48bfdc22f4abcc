"""Composed jobs: cleaning, star schema, marts and reports."""
