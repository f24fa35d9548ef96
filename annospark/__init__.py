"""Spark-native analysis and preparation of multi-annotator labelled text."""

__version__ = "0.1.0"
