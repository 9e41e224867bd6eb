"""Queries over the driver's tables, presented as a symbol bundle."""
