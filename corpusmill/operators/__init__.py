"""Operators over documents, units, examples and sequences."""
