"""Column functions: plain expressions, no Python runs per row."""
