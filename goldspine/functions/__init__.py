"""Column expressions: text, numbers, collections, semi-structured values."""
