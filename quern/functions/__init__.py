"""Column-level rules and functions."""
