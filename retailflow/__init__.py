"""Retail demand, pricing and serving operators written as PySpark DataFrame functions."""
