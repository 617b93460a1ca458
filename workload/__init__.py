"""Registered queries: the package's operators bound to the given tables."""
