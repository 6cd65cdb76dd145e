"""Relational operators over text tables."""
