"""Spark-first analytics for token-sequence corpora and per-entity event series."""
