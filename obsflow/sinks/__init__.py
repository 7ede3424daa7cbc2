"""Parquet writers for observations, chunks and text."""
