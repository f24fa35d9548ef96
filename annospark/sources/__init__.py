"""Readers and writers for annotated texts, annotators and scores."""
