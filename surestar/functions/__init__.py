"""Column expressions: text cleaning, lenient parsing and classification."""
