"""Branch sources, extracts and stored tables."""
