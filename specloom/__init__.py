"""Spectral-library preparation and similarity search on Spark DataFrames."""
