"""Operators of a training-data pipeline, their queries, and nothing the rest imports."""
