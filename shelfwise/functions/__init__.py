"""Column functions: each takes columns and returns a column, all from Spark's built-ins."""
