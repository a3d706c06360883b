"""Readers and writers for text documents, equation JSON and JSONL corpora."""
