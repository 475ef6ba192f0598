"""Column expressions (calendar, money)."""
