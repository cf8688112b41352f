"""Column functions: time, scalars."""
