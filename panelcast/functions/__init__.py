"""Column expressions: time, holidays and feature arithmetic."""
