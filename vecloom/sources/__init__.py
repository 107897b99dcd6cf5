"""Corpus readers and vector-table sinks."""
