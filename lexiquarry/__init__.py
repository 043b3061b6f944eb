"""Keyword selection and ranked search over text collections, as Spark DataFrame jobs."""

__version__ = "0.1.0"
