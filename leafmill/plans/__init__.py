"""Composed jobs that chain the operators over a working folder."""
