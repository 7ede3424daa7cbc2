"""Column expressions: text, numbers, dates, names and the fuzzy scorer."""
