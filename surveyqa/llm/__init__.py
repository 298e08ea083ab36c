"""Operators of a training-data pipeline: formatting, near-duplicates, packing, scoring, mixing, output.

Nothing else in the package imports this subpackage.
"""
