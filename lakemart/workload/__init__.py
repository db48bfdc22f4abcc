"""The registered queries: the engine applied to the retail parquet tables."""
