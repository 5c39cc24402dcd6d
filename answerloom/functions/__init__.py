"""Column expressions: text, ids, vectors."""
