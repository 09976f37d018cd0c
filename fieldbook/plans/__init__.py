"""Whole workflows composed from the operators, and a ready-made rule set."""
