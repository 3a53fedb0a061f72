"""Reusable DataFrame operators, independent of the retail tables."""
