"""Column expressions; all of them stay inside Spark's built-in functions."""
