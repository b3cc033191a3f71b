"""Column expressions and user functions."""
