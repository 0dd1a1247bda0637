"""Operators of a training-data pipeline: archives, cleaning, deduplication, mixing and packing.

Nothing else in the library imports this folder.
"""
