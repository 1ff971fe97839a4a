"""Column expressions for catalogue values; all of them built-in functions."""
