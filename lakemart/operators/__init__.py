"""Relational building blocks: DataFrame in, lazy DataFrame out."""
