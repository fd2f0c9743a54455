"""Operators that turn a document table into training data."""
