"""Queries over the operators, and whole runs."""
