"""Column-level helpers (all built-in expressions, no Python UDFs)."""
