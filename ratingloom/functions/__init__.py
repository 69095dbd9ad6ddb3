"""Column expressions: numbers, seeded hashes, text."""
