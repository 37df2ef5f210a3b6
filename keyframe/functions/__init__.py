"""Column expressions: typing, rounding, content hashing."""
