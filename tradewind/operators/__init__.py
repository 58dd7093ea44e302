"""Operators Spark has no single built-in for."""
