"""Column expressions: casts, flags, keys and measures."""
