"""Column expressions: money, dates, text. All are built-ins, none is a Python UDF."""
