"""Layered retail dimension tables as Spark jobs."""

__version__ = "0.1.0"
