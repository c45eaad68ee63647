"""Operators of a training-data pipeline: search, counting, deduplication, decontamination, packing, scoring.

Nothing else in the library imports this package. Operators take and return DataFrames; ``queries`` holds the thin
contract queries over the driver's tables.
"""
