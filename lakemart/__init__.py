"""lakemart: a PySpark-native retail lakehouse toolkit."""
