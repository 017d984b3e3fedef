"""Scalar functions on columns."""
