"""Composed steps, and the registered queries with their checks."""
