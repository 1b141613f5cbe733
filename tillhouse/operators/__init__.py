"""Joins, upserts, pair counts and rule checks."""
