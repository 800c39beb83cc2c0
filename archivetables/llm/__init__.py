"""Operators of a training-data pipeline over a table of documents.

A module per operator; ``queries`` registers them over the given tables. Nothing else in the
library imports this subpackage.
"""
