"""Operators on survey tables, rules and violations."""
