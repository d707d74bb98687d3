"""Operators for large training-data pipelines over the `documents` and `pages` tables."""
