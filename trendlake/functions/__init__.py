"""Column expressions: text, dates, numbers."""
