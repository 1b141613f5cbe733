"""Column functions and surrogate keys."""
