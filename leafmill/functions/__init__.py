"""Column expressions: they take and return ``Column`` and stay in the JVM."""
