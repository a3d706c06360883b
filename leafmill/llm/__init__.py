"""Operators for preparing training data, each a Spark job over tables of documents, pages or items."""
