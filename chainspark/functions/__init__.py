"""Column functions, and order helpers."""
