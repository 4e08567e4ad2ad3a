"""Column expressions and driver-side naming helpers."""
