"""Column expressions (projection layer): built-in functions only."""
