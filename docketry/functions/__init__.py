"""Column expressions (no UDFs): text, markup and URL helpers."""
