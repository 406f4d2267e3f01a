"""Column expressions and exact distributed ordering helpers."""
