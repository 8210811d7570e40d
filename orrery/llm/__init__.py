"""Operators of a training-data pipeline over text, pages and vectors.

Nothing outside this subpackage imports it; it may be deleted as a whole.
"""
