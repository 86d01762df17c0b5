"""Column expressions: each function takes and returns columns, so Catalyst sees all of it."""
