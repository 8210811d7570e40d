"""Spark library for customer, commerce and agency analytics on a galaxy schema."""

__version__ = "0.1.0"
