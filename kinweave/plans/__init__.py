"""Composed plans: the pipeline, the fixtures and the query catalogue."""
