"""Row-local building blocks: every function maps columns to columns."""
