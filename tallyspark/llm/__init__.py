"""Operators of a training-data pipeline (documents, pages and their labels).

Nothing else in the library imports this package.
"""
