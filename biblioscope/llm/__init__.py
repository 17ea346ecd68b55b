"""Operators of a training-data pipeline: tokens, counts, quality, near copies, extraction, leaks, safety.

Nothing else in the package imports this folder.
"""
