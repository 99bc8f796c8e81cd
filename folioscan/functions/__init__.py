"""Scalar functions on text, JSON and digests as Column expressions."""
