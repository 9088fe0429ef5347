"""Spark-first analytics for curating large collections of training conversations."""

__version__ = "0.1.0"
