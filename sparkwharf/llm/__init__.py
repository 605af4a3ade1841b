"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage; the folder can be removed
without touching the rest.
"""
