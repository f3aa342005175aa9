"""Spark-native curation of visually grounded question-answering data."""
