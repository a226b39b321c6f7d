"""All registered queries."""

from textloom.plans import queries_features, queries_retrieval, queries_text, queries_translation, queries_vocab
from textloom.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "queries_features", "queries_retrieval", "queries_text", "queries_translation", "queries_vocab"]
