"""Scalar column functions and ordered classification rules."""
