"""Operators for building training data out of a document corpus."""
