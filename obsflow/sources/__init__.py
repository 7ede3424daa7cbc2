"""Readers that turn sets of files into raw tables and paragraphs."""
