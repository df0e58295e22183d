"""Column functions: text, maps, numbers, seeded hashing."""
