"""Jobs, and the queries over the given tables."""
