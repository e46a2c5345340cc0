"""Operators of a training-data pipeline over the tables documents, conversations and benchmark.

Nothing else in the package imports this subpackage, so it can be removed as a whole.
"""
