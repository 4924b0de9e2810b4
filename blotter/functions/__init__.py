"""Column expressions: time parsing and classification."""
