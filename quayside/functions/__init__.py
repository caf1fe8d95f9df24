"""Column expressions: calendar arithmetic, lenient parsing, ids, keys, text."""
