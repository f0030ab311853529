"""Chunked runs over a directory of files."""
