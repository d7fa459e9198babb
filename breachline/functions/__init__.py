"""Column-returning helpers; all built from Spark's own expressions."""
