"""Leafmill: DataFrame operators that build text corpora on Apache Spark."""

__version__ = "0.1.0"
