"""Corpus analytics on PySpark DataFrames: text, vocabulary, retrieval, prompts and metrics."""
