"""Operators of a training-data pipeline over documents, labels, benchmarks and conversations."""
