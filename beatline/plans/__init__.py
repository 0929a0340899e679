"""Composed plans: the detection pipeline, the query registry and its oracle."""
