"""Column expressions: lenient parsing, text and vectors."""
