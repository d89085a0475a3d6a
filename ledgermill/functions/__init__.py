"""Column expressions: text, dates, money. None of them runs Python per row."""
