"""Column expressions and reporting windows."""
