"""Table operators: they take and return ``DataFrame``."""
