"""Column functions: JSON encode / decode."""
