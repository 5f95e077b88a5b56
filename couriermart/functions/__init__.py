"""Column helpers; each returns a built-in expression, never a UDF."""
