"""Operators and pipeline stages for building training data on Spark."""
