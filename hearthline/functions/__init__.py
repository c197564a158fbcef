"""Column expressions and small generated dimensions."""
