"""Operators that turn a document corpus into training data."""
