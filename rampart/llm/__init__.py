"""Operators of a training-data pipeline: tokenizing, search, scoring, de-duplication, packing.

The rest of the library does not import this package.
"""
