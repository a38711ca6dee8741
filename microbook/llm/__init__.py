"""Operators for training-data pipelines: ten methods over documents and pages."""
