"""Operators of a training-data pipeline over document and page tables."""
