"""Column -> Column functions and fixed values."""
