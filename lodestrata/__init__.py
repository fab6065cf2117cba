"""Lodestrata: document-to-knowledge-graph analytics as PySpark DataFrame operators."""
