"""Column to column functions; all built from Spark's own expressions."""
