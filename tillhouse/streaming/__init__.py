"""Receipts loaded as they arrive."""
