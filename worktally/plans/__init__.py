"""Composed queries and the pipeline."""
