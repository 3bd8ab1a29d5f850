"""Column expressions: text normalising, calendar arithmetic, small helpers."""
