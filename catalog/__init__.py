"""Queries over the given tables, and the SQL that gives the same rows."""
