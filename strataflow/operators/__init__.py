"""Reusable relational steps: deduplication, upsert, joins, ordered columns, quality counts."""
