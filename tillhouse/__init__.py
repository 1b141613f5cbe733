"""Retail hub-and-branch warehouse jobs written as Spark DataFrame plans."""
