"""Whole pipelines, and the queries over the stand-in tables."""
