"""Queries over the given tables, each beside the SQL that checks it."""
