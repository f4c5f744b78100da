"""Derived inputs, queries and their SQL twins, used by tests and bench."""
