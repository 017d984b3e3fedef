"""Operators from DataFrame to DataFrame, and the writers that need more than one job."""
