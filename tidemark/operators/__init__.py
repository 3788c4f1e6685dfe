"""Joins, aggregates, windows, folds and set operations over bank tables."""
