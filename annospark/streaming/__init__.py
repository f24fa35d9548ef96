"""Row-local annotation of a text stream."""
