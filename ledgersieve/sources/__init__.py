"""Inputs: transaction files, reference tables, generated rows, adapters for given tables."""
