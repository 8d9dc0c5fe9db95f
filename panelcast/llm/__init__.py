"""Operators of a training-data pipeline on documents, vectors and pages."""
